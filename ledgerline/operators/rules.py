"""Rules kept as data, evaluated against tables and views.

Operators: D1 resolve_rules (+ G1 baseline branch, D2 country explode), D3 gate_by_threshold,
C4-C9 rule predicates / scopes / log projection, D9 + E1 latest ingestion, I1 evaluate_rules
(one scan per object), I2 access_check, I3 move_ingestion_errors, E9 distinct_components.

The rules of a run are a small stored frame of (rule, country) rows.  Only the distinct predicates of an object are
compiled into its plan: a row yields the numbers of the predicates it satisfies, and these meet the rule frame in a join on
(predicate, country), which also carries the latest load of each country.  So the plan grows with the predicates, not with
the countries or the rules that share a predicate, and every object is scanned once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.dates import date_suffix
from ..functions.text import any_of, log_field_value
from ..session import store
from .history import replace_slice

RULE_COLUMNS = [
    "Country", "Stage", "ObjectType", "ObjectName", "ObjectField", "Operator", "ObjectFieldValue",
    "AdditionalCondition", "ErrorCode", "Recommendation", "ErrorDescription", "ErrorSeverity",
    "Type", "AdditionalFields", "CountryKeyField", "FileIngestionCondition", "Vendor", "Component",
]

LOG_SCHEMA = T.StructType([
    T.StructField("orchestratorid", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("sourcecomponent", T.StringType()),
    T.StructField("objectname", T.StringType()),
    T.StructField("errorseverity", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("errordescription", T.StringType()),
    T.StructField("erroridentifier", T.StringType()),
    T.StructField("createddttm", T.DateType()),
    T.StructField("recordtimestamp", T.TimestampNTZType()),
    T.StructField("recommendation", T.StringType()),
])


@dataclass
class RunContext:
    """Parameters of one quality run."""

    orchestrator_id: str
    stage: str
    region: str
    source: str
    run_date: str                      # YYYY-MM-DD
    component: str = ""
    vendor: str = ""
    now: _dt.datetime | None = None    # zone-less record timestamp; None -> the moment the context is made
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.now is None:  # one moment for all outputs of the run
            self.now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def record_ts(self) -> Column:
        return F.lit(self.now.isoformat(sep=" ")).cast("timestamp_ntz")

    def date_col(self) -> Column:
        return F.lit(self.run_date).cast("date")


# --------------------------------------------------------------------------- D1, G1, D2

def resolve_rules(config: DataFrame, error_map: DataFrame, severity_map: DataFrame,
                  fields_map: DataFrame, vendor_region: DataFrame, ctx: RunContext,
                  countries: list[str] | None = None, components: list[str] | None = None) -> DataFrame:
    """Active rules of (source, region, stage[, component]) with their error metadata.

    Inner joins on error code, severity, log-field code and vendor->region.  At the
    baseline stage the baseline-count rules are added again with blank error columns
    (UNION ALL, so a baseline rule with a valid error code appears twice).  The comma
    list in ``Country`` is exploded (no trimming) and kept when in ``countries``.
    """
    base = config.where(
        (F.col("Source") == F.lit(ctx.source))
        & (F.col("Stage") == F.lit(ctx.stage))
        & F.coalesce(F.col("IsActive"), F.lit(False))
    )
    if ctx.component:
        base = base.where(F.col("Component") == F.lit(ctx.component))
    if components is not None:  # component fan-out (I6) as one run over all components
        base = base.where(F.col("Component").isin(list(components)))
    vendors = vendor_region.where(F.col("Region") == F.lit(ctx.region)).select("Vendor")
    err = error_map.select(F.col("code").alias("ErrorCode"), F.col("Description").alias("ErrorDescription"),
                           "Type")
    sev = severity_map.select("SeverityID", F.col("SeverityDescription").alias("ErrorSeverity"))
    flds = fields_map.select("FieldsCode", F.col("LogFields").alias("AdditionalFields"))
    main = (
        base.join(err, "ErrorCode")
        .join(sev, "SeverityID")
        .join(flds, "FieldsCode")
        .join(vendors, "Vendor")
        .select(*RULE_COLUMNS)
    )
    if ctx.stage == K.BASELINE_STAGE:
        blank = F.lit("")
        baseline = (
            base.where(F.col("Operator") == F.lit(K.OP_BASELINEQUERY))
            .join(vendors, "Vendor")
            .select(
                "Country", "Stage", "ObjectType", "ObjectName", "ObjectField", "Operator",
                "ObjectFieldValue", "AdditionalCondition", "ErrorCode", "Recommendation",
                blank.alias("ErrorDescription"), blank.alias("ErrorSeverity"), blank.alias("Type"),
                blank.alias("AdditionalFields"), blank.alias("CountryKeyField"),
                blank.alias("FileIngestionCondition"), "Vendor", "Component",
            )
        )
        main = main.unionByName(baseline)
    out = main.withColumn("Country", F.explode(F.split(F.col("Country"), ",")))
    if countries is not None:
        out = out.where(F.col("Country").isin(list(countries)))
    return out


# --------------------------------------------------------------------------- D3 / E12

def gate_by_threshold(rules: DataFrame, flags: DataFrame | None, override: bool,
                      component: str = "", by_component: bool = False) -> DataFrame:
    """Keep rules of countries (and components) whose threshold was not exceeded.

    Bypassed when ``override`` is set or there are no flag rows.  Flag rows are
    ``{Country, Component?, Is_Threshold_Exceeded}``; only ``N`` lets a key through.
    Countries are compared upper-cased (and the gated rules carry the upper-cased
    country); the component takes part, null-safely, when the run names one or fans out over
    several (``by_component``).
    """
    if override or flags is None:
        return rules
    wanted = (component or by_component) and "Component" in flags.columns
    flags = store(flags.select(F.upper("Country").alias("__gc"), (F.col("Component") if wanted else F.lit(None)).cast("string").alias("__gm"),
                               (F.col("Is_Threshold_Exceeded") == F.lit(K.THRESHOLD_NOT_EXCEEDED)).alias("__ok")), "gate-flags")
    none = flags.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    keys = flags.where("__ok").distinct()
    cond = F.upper("Country") == F.col("__gc")
    if wanted:
        cond = cond & F.col("Component").eqNullSafe(F.col("__gm"))
    gated = rules.join(keys, cond, "left").withColumn("__none", none).where(F.col("__ok") | F.col("__none"))
    return gated.withColumn("Country", F.when(F.col("__none"), F.col("Country")).otherwise(F.upper("Country"))).select(*rules.columns)


# --------------------------------------------------------------------------- I1

@dataclass
class RuleProblem:
    objectname: str
    rule: dict
    error: str


@dataclass
class ViewFamily:
    """The dated output views of all countries as one frame: the view of a country is its rows with that ``country_col``."""

    frame: DataFrame
    country_col: str


#: What a rule compiles to, beside its country: rules that agree in these share one predicate of the object's plan.
_PREDICATE = ["object", "kind", "mode", "condition", "ingestion", "key_field", "fields"]
_KEY = "__rule_country"  # stands for the rule's country in a predicate that only meets rows of that country


def _bound(c: Column, ctx: RunContext) -> Column:
    """Date token and region bound; the country stays."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit(K.DATE_TOKEN), F.lit(ctx.run_date))
    return F.replace(c, F.lit(K.REGION_PLACEHOLDER), F.lit(ctx.region or ""))


def _rule_frame(rules: DataFrame, families: Mapping[str, ViewFamily], ctx: RunContext) -> DataFrame:
    """(rule, country) rows with what each compiles to (``_PREDICATE``) and its texts, bound.

    ``mode``: ``eq`` (rows of the rule's country), ``ne`` (rows of any other), ``all``; ``kind``: ``history``, ``raw``, ``view``.
    """
    def lower(text):
        return F.lit((text or "").lower())
    country = F.coalesce("Country", F.lit(""))
    name = F.replace(F.replace(F.col("ObjectName"), F.lit(K.REGION_PLACEHOLDER), lower(ctx.region)),
                     F.lit(K.VENDOR_PLACEHOLDER), F.lower(F.coalesce("Vendor", F.lit(""))))
    is_view = F.lower(F.coalesce("ObjectType", F.lit(""))) == "view"
    family = is_view & name.isin(*families) if families else F.lit(False)
    own = F.replace(F.replace(name, F.lit(K.COUNTRY_PLACEHOLDER), F.lower(country)), F.lit(K.COMPONENT_PLACEHOLDER), F.lit(""))
    suffix = F.when(is_view, F.lit("_" + date_suffix(ctx.run_date))).otherwise(F.lit(""))
    is_table = F.lower(F.coalesce("ObjectType", F.lit(""))) == "table"
    kind = (F.when(family, "family").when(~is_table, "view").when(own.endswith(K.HISTORY_SUFFIX), "history").otherwise("raw"))
    key_field = F.when(is_table, F.replace(_bound(F.col("CountryKeyField"), ctx), F.lit(K.COUNTRY_PLACEHOLDER), country)).otherwise("")
    mode = (F.when(family, "eq").when(~is_table | (key_field == ""), "all")
            .when(F.col("ErrorCode") == F.lit(K.COUNTRY_ERROR_CODE), "ne").otherwise("eq"))

    def with_country(text: Column, inside: Column) -> Column:
        """A quoted country is the row's own where only rows of that country are met; elsewhere its text is bound."""
        quoted = F.replace(text, F.lit(f"'{K.COUNTRY_PLACEHOLDER}'"), F.lit(_KEY))
        keep = inside & ~F.contains(quoted, F.lit(K.COUNTRY_PLACEHOLDER))
        return F.when(keep, quoted).otherwise(F.replace(text, F.lit(K.COUNTRY_PLACEHOLDER), country))

    def text(c: str) -> Column:
        return F.replace(_bound(F.col(c), ctx), F.lit(K.COUNTRY_PLACEHOLDER), country)
    condition = _bound(F.col("AdditionalCondition"), ctx)
    ingestion = F.when(kind == "raw", F.trim(_bound(F.col("FileIngestionCondition"), ctx))).otherwise("")
    return rules.where(F.upper(F.coalesce("Operator", F.lit(""))) != F.lit(K.OP_BASELINEQUERY)).select(
        F.col("Country").alias("country"), F.when(family, name).otherwise(F.concat(own, suffix)).alias("object"),
        F.concat(own, suffix).alias("objectname"), kind.alias("kind"), mode.alias("mode"),
        with_country(F.when(condition == "", F.lit("TRUE")).otherwise(condition), mode == "eq").alias("condition"),
        with_country(ingestion, F.lit(True)).alias("ingestion"), key_field.alias("key_field"),
        F.trim(F.coalesce("AdditionalFields", F.lit(""))).alias("fields"),
        F.col("Component").cast("string").alias("sourcecomponent"), F.col("ErrorSeverity").cast("string").alias("errorseverity"),
        F.col("Type").cast("string").alias("type"), text("ErrorDescription").alias("description"),
        F.col("ObjectField").cast("string").alias("erroridentifier"),
        F.when(F.col("Recommendation").isNotNull(), text("Recommendation")).alias("recommendation"))


def evaluate_rules(rules: DataFrame | list[dict], objects: Callable[[str], DataFrame] | Mapping[str, DataFrame],
                   ctx: RunContext, alias: DataFrame | None = None,
                   families: Mapping[str, ViewFamily] | None = None) -> tuple[DataFrame | None, list[RuleProblem]]:
    """Violation log rows of table / view rules, one scan per object.

    Per rule: bind placeholders; views get the ``_YYYY_MM_DD`` suffix; the predicate is the configured condition
    (parenthesised).  Tables add a row scope: names ending in ``history`` -> ``createddttm = run date``; others -> latest load
    of the rule's country (``rawingestiondttm = max`` under the ingestion condition, one aggregate per country key for all
    rules of the object).  With a country field: ``E004`` rules keep rows whose country key is not the rule's country, other
    rules rows whose key is.  ``families`` gives the views of all countries by their configured name, country placeholder
    included: they are evaluated together, in one scan.

    A predicate that does not analyse against its object is reported and skipped; the other rules still run.  Returns
    ``(log_rows or None, problems)``.
    """
    families = dict(families or {})
    if not isinstance(rules, DataFrame):
        spark = SparkSession.active()
        schema = T.StructType([T.StructField(c, T.StringType()) for c in RULE_COLUMNS])
        rules = spark.createDataFrame([tuple(r.get(c) for c in RULE_COLUMNS) for r in rules], schema)
    frame = store(_rule_frame(rules, families, ctx), "rules")
    resolve = objects.__getitem__ if isinstance(objects, Mapping) else objects
    # the distinct predicates are what compiles into the plans: configuration, without the countries
    by_object: dict[str, list[dict]] = {}
    for r in frame.groupBy(*_PREDICATE).agg(F.min("objectname").alias("objectname")).orderBy(*_PREDICATE).collect():
        by_object.setdefault(r["object"], []).append(r.asDict())
    problems: list[RuleProblem] = []
    frames = []
    for name, predicates in by_object.items():
        family = families.get(name) if predicates[0]["kind"] == "family" else None
        try:
            src = family.frame if family else resolve(name)
        except Exception as e:  # missing object: every rule of it fails
            problems += [RuleProblem(p["objectname"], p, f"object not found: {e}") for p in predicates]
            continue
        own = frame.where(F.col("object") == F.lit(name))
        log = _evaluate_object(src, predicates, own, ctx, alias, family, problems)
        if log is not None:
            frames.append(log)
    if not frames:
        return None, problems
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, problems


def _case(values: dict[int, Column]) -> Column:
    """``CASE number WHEN n THEN values[n] ...``."""
    expr = None
    for n, v in values.items():
        expr = F.when(F.col("__n") == n, v) if expr is None else expr.when(F.col("__n") == n, v)
    return expr


def _evaluate_object(src: DataFrame, predicates: list[dict], rules: DataFrame, ctx: RunContext, alias: DataFrame | None,
                     family: ViewFamily | None, problems: list[RuleProblem]) -> DataFrame | None:
    df, keys = src, {}
    for i, f in enumerate(sorted({p["key_field"] for p in predicates if p["key_field"]})):
        keys[f] = f"__ck{i}"
        if alias is None:
            df = df.withColumn(keys[f], F.expr(f).cast("string"))
        else:
            a = alias.select(F.col("raw").alias(f"__ar{i}"), F.col("key").cast("string").alias(keys[f]))
            df = df.join(a, F.expr(f) == F.col(f"__ar{i}"), "left").drop(f"__ar{i}")
    if family is not None:
        keys[""] = "__ck"
        df = df.withColumn("__ck", F.col(family.country_col).cast("string"))

    def parse(text: str, key: str | None) -> Column:
        return F.expr("(" + (text.replace(_KEY, f"`{key}`") if key else text) + ")")

    good, loads = {}, {}
    for n, p in enumerate(predicates):
        key = keys.get(p["key_field"])
        try:
            cond = F.coalesce(parse(p["condition"], key), F.lit(False))
            if p["kind"] == "history":
                cond = cond & (F.col("createddttm") == ctx.date_col())
            elif p["kind"] == "raw":
                if key is None:
                    raise ValueError("table rule without a country field cannot select the latest load")
                scope = parse(p["ingestion"], key) if p["ingestion"] else F.lit(True)
                loads[n] = (key, F.max(F.when(scope, F.col("rawingestiondttm"))))
                df.agg(loads[n][1])
            names = [x for x in p["fields"].split(",")] if p["fields"] else src.columns
            text = F.concat_ws("|", *[F.concat(F.lit(x + ":"), log_field_value(F.col(f"`{x.strip()}`"))) for x in names])
            good[n] = (cond, text)
        except Exception as e:
            problems.append(RuleProblem(p["objectname"], p, str(e).splitlines()[0]))
            loads.pop(n, None)
    try:  # analyse all of them at once; only when that fails, find the bad ones one by one
        df.select(*[c for pair in good.values() for c in pair])
    except Exception:
        for n in list(good):
            try:
                df.select(*good[n])
            except Exception as e:
                problems.append(RuleProblem(predicates[n]["objectname"], predicates[n], str(e).splitlines()[0]))
                del good[n]
                loads.pop(n, None)
    if not good:
        return None
    numbers = SparkSession.active().createDataFrame(
        [(n, *(predicates[n][c] for c in _PREDICATE)) for n in good], "__n int, " + ", ".join(f"{c} string" for c in _PREDICATE))
    texts = ["country", "sourcecomponent", "objectname", "errorseverity", "type", "description", "erroridentifier", "recommendation"]
    meet = rules.join(numbers, _PREDICATE).select(
        F.col("__n").alias("__rn"), F.when(F.col("mode") == "eq", F.col("country")).otherwise(F.lit("")).alias("__rk"),
        (F.col("mode") == "ne").alias("__other"), *[F.col(c).alias(f"__r_{c}") for c in texts])
    latest = None
    for key in sorted({k for k, _ in loads.values()}):
        own = {n: v for n, (k, v) in loads.items() if k == key}
        per_key = df.groupBy(F.col(key).alias("__lc")).agg(*[v.alias(f"__m{n}") for n, v in own.items()])
        long = per_key.select("__lc", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"__m{n}").alias("m")) for n in own]))
                              .alias("x")).select("__lc", F.col("x.n").alias("__ln"), F.col("x.m").alias("__latest"))
        latest = long if latest is None else latest.unionByName(long)
    if latest is not None:
        meet = meet.join(latest, (F.col("__rn") == F.col("__ln")) & (F.col("__r_country") == F.col("__lc")), "left").drop("__ln", "__lc")

    scoped = {keys[predicates[n]["key_field"]] if predicates[n]["mode"] == "eq" else None for n in good}
    if len(scoped) == 1 and None not in scoped:  # only rows of the run's countries can match: the others needn't be looked at
        countries = rules.select(F.col("country").alias("__wanted")).distinct()
        df = df.join(countries, F.col(next(iter(scoped))) == F.col("__wanted"), "left_semi")
    hits = df.where(any_of([c for c, _ in good.values()])).withColumn(
        "__n", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, (c, _) in good.items()]))))
    own_key = _case({n: F.col(keys[predicates[n]["key_field"]]) if predicates[n]["mode"] != "all" else F.lit("") for n in good})
    text = _case({n: t for n, (_, t) in good.items()})
    eq = F.lit(True)
    if any(predicates[n]["mode"] != "eq" for n in good):
        eq = ~F.col("__other") | (F.coalesce("__k", F.lit("")) != F.col("__r_country"))
    hits = hits.withColumn("__k", own_key)
    join_key = _case({n: F.col("__k") if predicates[n]["mode"] == "eq" else F.lit("") for n in good})
    cond = (F.col("__n") == F.col("__rn")) & (join_key == F.col("__rk")) & eq
    if latest is not None:
        raw = [n for n in good if n in loads]
        fresh = F.col("rawingestiondttm") == F.col("__latest")
        cond = cond & (fresh if len(raw) == len(good) else ~F.col("__n").isin(raw) | fresh)
    found = hits.withColumn("__text", text).join(meet, cond).select(
        *[F.col(f"__r_{c}").alias(c) for c in texts if c != "description"],
        F.concat(F.col("__r_description"), F.lit(";"), F.col("__text")).alias("errordescription"))
    return _with_run_columns(found, ctx)


def _with_run_columns(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.select(
        F.lit(ctx.orchestrator_id).alias("orchestratorid"),
        F.lit(ctx.stage).alias("stage"),
        F.lit(ctx.region).alias("region"),
        "country",
        F.lit(ctx.source).alias("source"),
        "sourcecomponent", "objectname", "errorseverity", "type", "errordescription",
        "erroridentifier",
        ctx.date_col().alias("createddttm"),
        ctx.record_ts().alias("recordtimestamp"),
        "recommendation",
    )


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


# --------------------------------------------------------------------------- I2

@dataclass
class AccessResult:
    log: DataFrame                 # the whole validation log after replacing the run's slice
    violations: DataFrame          # rows produced by this run
    problems: list[RuleProblem]


def log_slice(ctx: RunContext, countries: list[str] | None, components: list[str] | None = None,
              stage: str | None = None) -> Column:
    """Delete key of a run's slice of the validation log."""
    pred = (
        (F.col("createddttm") == ctx.date_col())
        & (F.col("source") == F.lit(ctx.source))
        & (F.col("region") == F.lit(ctx.region))
        & (F.col("stage") == F.lit(stage or ctx.stage))
        & (F.col("orchestratorid") == F.lit(ctx.orchestrator_id))
    )
    if components:
        pred = pred & F.col("sourcecomponent").isin(components)
    if countries:
        pred = pred & F.col("country").isin(countries)
    return pred


def access_check(rules: DataFrame, objects, ctx: RunContext, log: DataFrame, countries: list[str],
                 flags: DataFrame | None = None, override: bool = False,
                 alias: DataFrame | None = None, components: list[str] | None = None) -> AccessResult:
    """Table-level quality run: gate -> evaluate (one scan per object) -> replace the log slice.

    Unlike the original job, the slice is replaced even when no rule survives, so a rerun
    never leaves stale violations.  ``problems`` lists rules that could not run; callers
    raise after writing the log (a failing rule does not stop the others).
    """
    gated = gate_by_threshold(rules, flags, override, ctx.component, components is not None)
    viol, problems = evaluate_rules(gated, objects, ctx, alias)
    if viol is None:
        viol = empty_log(log.sparkSession)
    comps = components if components is not None else ([ctx.component] if ctx.component else None)
    new_log = replace_slice(log, viol.select(*log.columns), log_slice(ctx, countries, comps))
    return AccessResult(new_log, viol, problems)


# --------------------------------------------------------------------------- I3, A9

def is_ingestion_source(processes: DataFrame, source: str) -> bool:
    """Membership of the data source in the (lower-cased, distinct) ingestion process list."""
    return processes.where(F.lower("Process") == F.lit(source.lower())).limit(1).count() > 0


def move_ingestion_errors(ingestion_log: DataFrame, log: DataFrame, ctx: RunContext,
                          countries: list[str]) -> DataFrame:
    """Replace the run's ``Ingestion`` slice of the log with rows of the ingestion error log.

    Rows keep their own stage/region/... values; identifier and recommendation are blank,
    ``createddttm`` is the run date.  An empty country list moves nothing.
    """
    comp = [ctx.component] if ctx.component else None
    incoming = ingestion_log.where(
        (F.col("source") == F.lit(ctx.source))
        & (F.col("region") == F.lit(ctx.region))
        & F.col("country").isin(countries or [])
    )
    if comp:
        incoming = incoming.where(F.col("sourcecomponent") == F.lit(ctx.component))
    incoming = incoming.select(
        F.lit(ctx.orchestrator_id).alias("orchestratorid"),
        *K.INGESTION_ERROR_COLUMNS,
        F.lit("").alias("erroridentifier"),
        ctx.date_col().alias("createddttm"),
        ctx.record_ts().alias("recordtimestamp"),
        F.lit("").alias("recommendation"),
    )
    pred = log_slice(ctx, countries, comp, stage=K.INGESTION_STAGE)
    return replace_slice(log, incoming.select(*log.columns), pred)


# --------------------------------------------------------------------------- E9 / I6

def distinct_components(executions: DataFrame, by_country: bool) -> DataFrame:
    """Region run: distinct components; country run: every execution."""
    if by_country:
        return executions
    return executions.select("component").distinct()


def run_access_check(spark: SparkSession, rules: DataFrame, objects, ctx: RunContext, log_path: str,
                     countries: list[str], flags: DataFrame | None = None, override: bool = False,
                     alias: DataFrame | None = None, components: list[str] | None = None) -> list[RuleProblem]:
    """I2 against a validation log stored as Parquet partitioned by its delete key (``sinks.slices.LOG_SLICE``).

    Only the run's own slices are replaced.  Rules that could not run are raised after the log is written, so one bad rule
    never hides the results of the others.
    """
    from ..sinks.slices import LOG_SLICE, replace_slices
    gated = gate_by_threshold(rules, flags, override, ctx.component, components is not None)
    viol, problems = evaluate_rules(gated, objects, ctx, alias)
    if viol is None:
        viol = empty_log(spark)
    comps = components if components is not None else ([ctx.component] if ctx.component else None)
    own = dict(createddttm=[ctx.run_date], source=[ctx.source], region=[ctx.region], stage=[ctx.stage],
               orchestratorid=[ctx.orchestrator_id])
    own |= {"sourcecomponent": comps} if comps else {}
    own |= {"country": sorted({*countries, *(c.upper() for c in countries)})} if countries else {}  # gated rules are upper-cased
    replace_slices(spark, log_path, viol, LOG_SLICE, own)
    if problems:
        raise RuntimeError(f"{len(problems)} rule(s) failed: " + "; ".join(f"{p.objectname}: {p.error}" for p in problems))
    return problems
