"""Record-file checks: one record per line, fields split on ``|"``, field 0 is the record type.

Operators: C13 file_scope, D6 record_rule_join (compile_rules), H1-H11 checks, D7 membership, D8 currency lookup with
fallback, H12/C11 check_and_split.

Rules are configuration: each compiles on the driver into a literal expression (index, pattern, list and date format are
constants).  The rules of a record type form one branch of ``CASE record_type WHEN t THEN [1 if bad_1, 2 if bad_2, ...]``, so a
line evaluates only its own type's rules and yields the numbers of those it breaks; log entries are made of these.  Membership and currencies are plain equi-joins with the reference (record type, value), at any size: the planner
broadcasts a reference that is small and shuffles by the pair otherwise, splitting skewed pairs.
Every check is a built-in expression: no Python runs per line.
"""

from __future__ import annotations

from calendar import monthrange
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import bind_name, bind_query, parse_fields_literal, parse_list_literal, prefix_match

KNOWN_OPS = {K.OP_IN, K.OP_NOTIN, K.OP_DATEFORMAT, K.OP_AMOUNTFORMAT, K.OP_HOURSFORMAT,
             K.OP_INFOTYPECOMBINATIONFORMAT, K.OP_WAGETYPECHECK, K.OP_COUNTRYCHECK,
             K.OP_CURRENCYCHECK, K.OP_WAGETYPECURRENCYCHECK}


# --------------------------------------------------------------------------- C13

def file_scope(rules: DataFrame, vendor: str, region: str, country: str, source_path: str,
               source_object: str, replace_last: bool = True) -> DataFrame:
    """Rules of one output file: ``vendor/region/`` prefix, placeholders bound (lower-cased),
    last path part swapped for the file object, kept when equal to the file path ignoring case."""
    name = F.concat(F.lit(f"{vendor}/{region}/"), F.col("ObjectName"))
    for token, val in ((K.COUNTRY_PLACEHOLDER, country), (K.REGION_PLACEHOLDER, region),
                       (K.VENDOR_PLACEHOLDER, vendor)):
        name = F.replace(name, F.lit(token), F.lit((val or "").lower()))
    if replace_last:
        obj = source_object.replace("\\", "\\\\").replace("$", "\\$")
        name = F.regexp_replace(name, r"^((?:.*/)?)[^/]*$", F.lit("$1" + obj))
    target = (source_path + source_object).lower()
    return rules.withColumn("ObjectName", name).where(F.lower("ObjectName") == F.lit(target))


# --------------------------------------------------------------------------- D6 (compile)

@dataclass(frozen=True)
class CompiledRule:
    """One rule with its literals parsed."""

    record_type: str
    index: int
    op: str
    params: tuple[str, ...]
    pattern: str | None
    date_format: str | None
    fields: tuple[tuple[int, str], ...]
    identifier: str | None
    wagetype_index: int | None       # field of the record's wage type (WAGETYPECURRENCYCHECK)
    severity: str | None
    type: str | None
    description: str
    recommendation: str | None


@dataclass
class CompiledRules:
    rows: list[CompiledRule]
    unknown: list[dict]              # H11: operators with no check (logged, never violate)
    baseline_queries: list[str]      # distinct BASELINEQUERY texts
    wagetype_queries: list[str]      # distinct reference queries of WAGETYPECHECK rules
    infotype_queries: list[str]      # distinct reference queries of INFOTYPECOMBINATIONFORMAT rules


def _position(text) -> int | None:
    """Positions are matched as the text of the index ("2"); "02" or "" never applies."""
    text = str(text or "")
    return int(text) if text.isdigit() and str(int(text)) == text else None


def compile_rule(r: dict, wagetype_index: int | None = None) -> CompiledRule | None:
    """A rule row with a known operator, parsed; None where its position can't apply."""
    op, idx = (r.get("Operator") or "").upper(), _position(r.get("ObjectField"))
    if idx is None:
        return None
    fields = tuple((i, n) for i, n in parse_fields_literal(r.get("AdditionalFields") or ""))
    value = r["ObjectFieldValue"]
    return CompiledRule(
        r["AdditionalCondition"], idx, op, tuple(parse_list_literal(value)) if op in (K.OP_IN, K.OP_NOTIN) else (),
        value if op in (K.OP_DATEFORMAT, K.OP_AMOUNTFORMAT, K.OP_HOURSFORMAT) else None,
        K.DATE_REGEX_FORMATS.get(value, "yyyyMMdd") if op == K.OP_DATEFORMAT else None,
        fields, dict(fields).get(idx), wagetype_index if op == K.OP_WAGETYPECURRENCYCHECK else None,
        r.get("ErrorSeverity"), r.get("Type"), r.get("ErrorDescription") or "", r.get("Recommendation"))


def compile_rules(spark: SparkSession, rules: DataFrame | list[dict]) -> CompiledRules:
    """The resolved rules of one file, compiled (configuration: the file's rule rows go to the driver)."""
    rows = [r.asDict() for r in rules.collect()] if isinstance(rules, DataFrame) else list(rules)
    out, unknown, queries = [], [], {K.OP_BASELINEQUERY: [], K.OP_WAGETYPECHECK: [], K.OP_INFOTYPECOMBINATIONFORMAT: []}
    wt_index: dict[str, int] = {}    # wage-type field of each record type: its first WAGETYPECHECK rule's
    for r in rows:
        if (r.get("Operator") or "").upper() == K.OP_WAGETYPECHECK and r["AdditionalCondition"] not in wt_index:
            idx = _position(r.get("ObjectField"))
            if idx is not None:
                wt_index[r["AdditionalCondition"]] = idx
    for r in rows:
        op = r.get("Operator") or ""
        if op in queries and r["ObjectFieldValue"] not in queries[op] and (
                op == K.OP_BASELINEQUERY or _position(r.get("ObjectField")) is not None):
            queries[op].append(r["ObjectFieldValue"])
        if op.upper() == K.OP_BASELINEQUERY:
            continue
        if op.upper() not in KNOWN_OPS:
            unknown.append(r)
            continue
        rule = compile_rule(r, wt_index.get(r["AdditionalCondition"]))
        if rule is not None:
            out.append(rule)
    return CompiledRules(out, unknown, *queries.values())


#: Columns of a rule row that the checks of a record file use.
FILE_RULE_COLUMNS = ["ObjectField", "Operator", "ObjectFieldValue", "AdditionalCondition", "AdditionalFields", "ErrorSeverity",
                     "Type", "ErrorDescription", "Recommendation"]
_WORD = 62  # rules per word of a bitmap


def compile_file_rules(rules: DataFrame, file_key: str) -> tuple[CompiledRules, DataFrame]:
    """Rules of many files at once: the distinct rules compiled, and which files each applies to.

    ``rules`` has ``file_key`` beside the rule columns.  Returns the compiled rules and ``(file_key, rule_bits)``, a bitmap
    over them per file.  Rules that several files share are compiled once, so the expressions grow with the distinct rules,
    not with the files.  A rule that a file has twice counts twice.
    """
    from ..session import store
    op = F.upper(F.coalesce("Operator", F.lit("")))
    position = F.when(op == K.OP_WAGETYPECHECK, F.col("ObjectField").try_cast("int"))
    of_type = F.min(position).over(Window.partitionBy(file_key, "AdditionalCondition"))
    own = rules.where(op != K.OP_BASELINEQUERY).select(
        file_key, *FILE_RULE_COLUMNS, F.when(op == K.OP_WAGETYPECURRENCYCHECK, of_type).alias("wt_index"))
    row = F.to_json(F.struct(*FILE_RULE_COLUMNS, "wt_index"))
    nth = F.row_number().over(Window.partitionBy(file_key, "rule").orderBy(F.lit(1)))
    own = store(own.withColumn("rule", row).withColumn("nth", nth), "file-rules")
    known, unknown, at = [], [], []
    for r in own.select("rule", "nth", *FILE_RULE_COLUMNS, "wt_index").distinct().orderBy("rule", "nth").collect():
        d = r.asDict()
        if (d["Operator"] or "").upper() not in KNOWN_OPS:
            unknown.append(d)
        elif (rule := compile_rule(d, d["wt_index"])) is not None:
            at.append((r["rule"], r["nth"], len(known)))
            known.append(rule)
    spark = rules.sparkSession
    numbers = spark.createDataFrame(at, "rule string, nth int, number int") if at else \
        spark.createDataFrame([], "rule string, nth int, number int")
    words = -(-max(1, len(known)) // _WORD)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number") % _WORD)
    bits = own.join(numbers, ["rule", "nth"]).groupBy(file_key).agg(F.array(*[
        F.bit_or(F.when(F.floor(F.col("number") / _WORD) == w, bit).otherwise(F.lit(0).cast("long"))) for w in range(words)])
        .alias("rule_bits"))
    return CompiledRules(known, unknown, [], [], []), bits


# --------------------------------------------------------------------------- A5 parse

def parts_of(line: Column) -> Column:
    """All parts of a line, trailing empties kept."""
    return F.split(line, r'\|"', -1)


def parse_records(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``fields`` (all parts, trailing empties kept) and ``record_type`` (field 0).

    The record type is taken with ``substring_index`` (text before the first separator):
    the same value as field 0, but cheap enough that the null check the optimizer infers
    from the rule join does not re-split every line.
    """
    fields = parts_of(F.col(line_col))
    rtype = F.substring_index(F.col(line_col), K.RECORD_FIELD_SEPARATOR, 1)
    return lines.withColumn("fields", fields).withColumn("record_type", rtype)


# --------------------------------------------------------------------------- references

@dataclass
class References:
    """Reference data of one run (all optional).

    The checks compare with ``country``, or with the line's own ``country_col`` where lines of several countries are
    checked together; the wage types then carry a ``Country`` column if they differ by country.
    """

    country: str | None = None
    datasource: str = ""
    wagetypes: DataFrame | None = None        # (Wagetype, Infotype[, Country])
    infotypes: DataFrame | None = None        # (Country, Infotype, Wagetype)
    currencykey: DataFrame | None = None      # (CountryKey, CurrencyKey)
    wagetype_currency: DataFrame | None = None  # (Country, WageType, DataSource, CurrencyKey)
    country_col: str | None = None


def _by_type(values: dict[str, Column]) -> Column | None:
    """``CASE record_type WHEN t THEN values[t] ...``."""
    expr = None
    for t, v in values.items():
        test = F.col("record_type") == F.lit(t)
        expr = F.when(test, v) if expr is None else expr.when(test, v)
    return expr


def _attach_members(df: DataFrame, ref: DataFrame | None, rules: list[CompiledRule], refs: References, name: str) -> DataFrame:
    """Add ``__<name>_on`` (the reference has entries) and, for the i-th position that a record type checks, ``__<name>_<i>``
    (the value there is one of the type's)."""
    on = f"__{name}_on"
    places: dict[str, list[int]] = {}
    for r in rules:
        if r.index not in places.setdefault(r.record_type, []):
            places[r.record_type].append(r.index)
    if ref is None or not rules:
        return df.withColumn(on, F.lit(False))
    by_country = refs.country_col is not None and "Country" in ref.columns
    if by_country:
        some = ref.select(F.col("Country").alias("__c")).distinct().withColumn(on, F.lit(True))
        df = df.join(some, F.col(refs.country_col) == F.col("__c"), "left").drop("__c").withColumn(on, F.coalesce(on, F.lit(False)))
    else:
        df = df.withColumn(on, ref.limit(1).agg(F.count(F.lit(1)) > 0).scalar())
        if "Country" in ref.columns:
            ref = ref.where(F.col("Country") == F.lit(refs.country))
    for i in range(max(map(len, places.values()))):
        value = _by_type({t: F.get("fields", F.lit(at[i])) for t, at in places.items() if i < len(at)})
        keys = [F.col("Infotype").alias("__t"), F.col("Wagetype").alias("__v"), *([F.col("Country").alias("__c")] if by_country else [])]
        member = ref.select(*keys).distinct().withColumn(f"__{name}_{i}", F.lit(True))
        cond = (F.col("record_type") == F.col("__t")) & (F.col("__value") == F.col("__v"))
        if by_country:
            cond = cond & (F.col(refs.country_col) == F.col("__c"))
        df = df.withColumn("__value", value).join(member, cond, "left").drop("__t", "__v", "__c", "__value")
    return df


def _attach_currencies(df: DataFrame, rules: list[CompiledRule], refs: References) -> DataFrame:
    """Add ``__ccy`` (the country's currency, D8) and ``__wc`` (the currency of the line's wage type)."""
    none = F.lit(None).cast("string")
    used = any(r.op in (K.OP_CURRENCYCHECK, K.OP_WAGETYPECURRENCYCHECK) for r in rules)
    if refs.currencykey is None or not used:
        df = df.withColumn("__ccy", none)
    elif refs.country_col is None:
        own = refs.currencykey.where(F.col("CountryKey") == F.lit(refs.country))
        df = df.withColumn("__ccy", own.agg(F.min("CurrencyKey")).scalar())
    else:
        keys = refs.currencykey.groupBy(F.col("CountryKey").alias("__c")).agg(F.min("CurrencyKey").alias("__ccy"))
        df = df.join(keys, F.col(refs.country_col) == F.col("__c"), "left").drop("__c")
    wage_type = _by_type({r.record_type: F.get("fields", F.lit(r.wagetype_index)) for r in rules if r.wagetype_index is not None})
    if refs.wagetype_currency is None or wage_type is None:
        return df.withColumn("__wc", none)
    wc = refs.wagetype_currency.where(F.col("DataSource") == F.lit(refs.datasource))
    cond = F.col("__value") == F.col("__v")
    if refs.country_col is None:
        wc = wc.where(F.col("Country") == F.lit(refs.country))
        keys = [F.col("WageType").alias("__v")]
    else:
        keys = [F.col("WageType").alias("__v"), F.col("Country").alias("__c")]
        cond = cond & (F.col(refs.country_col) == F.col("__c"))
    wc = wc.groupBy(*keys).agg(F.min("CurrencyKey").alias("__wc"))
    return df.withColumn("__value", wage_type).join(wc, cond, "left").drop("__v", "__c", "__value")


# --------------------------------------------------------------------------- H1-H10

_DAYS = [f"{m:02d}{d:02d}" for m in range(1, 13) for d in range(1, monthrange(2023, m)[1] + 1)]  # of a year without 29 February


def _no_date(v: Column, r: CompiledRule) -> Column:
    """Whether ``v``, which matches the rule's pattern, is no date of the calendar.

    Parsing raises and catches an exception for every bad date; after the one pattern that stands for eight digits, the day is
    looked up instead, and only what the look-up can't tell is parsed.
    """
    parsed = F.try_to_timestamp(v, F.lit(r.date_format)).isNull()
    if K.DATE_REGEX_FORMATS.get(r.pattern) != "yyyyMMdd":
        return parsed
    day = F.substring(v, 5, 4)
    plain = (F.length(v) == 8) & ~v.startswith("0000") & (day != "0229")
    return F.when(plain, ~day.isin(_DAYS)).otherwise(parsed)


def _violated(r: CompiledRule, country: Column, member: Column) -> Column:
    v = F.get("fields", F.lit(r.index))
    if r.index < 1:
        return F.lit(False)
    if r.op in (K.OP_IN, K.OP_NOTIN):
        found = F.array_contains(F.array(*[F.lit(x) for x in r.params]).cast("array<string>"), v)
        bad = found if r.op == K.OP_IN else ~found
    elif r.op == K.OP_DATEFORMAT:
        bad = ~prefix_match(v, r.pattern) | _no_date(v, r)
    elif r.op in (K.OP_AMOUNTFORMAT, K.OP_HOURSFORMAT):
        bad = (v != "") & ~prefix_match(v, r.pattern)
    elif r.op == K.OP_COUNTRYCHECK:
        bad = ~v.eqNullSafe(country)
    elif r.op == K.OP_CURRENCYCHECK:
        bad = ~v.eqNullSafe(F.col("__ccy"))
    elif r.op == K.OP_WAGETYPECURRENCYCHECK:
        bad = ~v.eqNullSafe(F.coalesce("__wc", "__ccy"))
    else:
        bad = F.when(member.isNull(), F.lit(False)).otherwise(~member | (v == ""))
    return (F.size("fields") > F.lit(r.index)) & F.coalesce(bad, F.lit(False))


def check_lines(records: DataFrame, compiled: CompiledRules, refs: References, rule_bits: str | None = None) -> DataFrame:
    """Parsed records with ``violated``: the numbers of the rules that the line breaks (empty for a clean line).

    With ``rule_bits``, a bitmap column of ``compile_file_rules``, a line meets only its own file's rules; a null bitmap
    means none.  ``violations_of`` gives the log entries.
    """
    rules = compiled.rows
    checks = {K.OP_WAGETYPECHECK: ("wt", refs.wagetypes), K.OP_INFOTYPECOMBINATIONFORMAT: ("it", refs.infotypes)}
    df = _attach_currencies(records, rules, refs)
    places: dict[tuple[str, str], list[int]] = {}
    for op, (name, ref) in checks.items():
        own = [r for r in rules if r.op == op]
        df = _attach_members(df, ref, own, refs, name)
        for r in own:
            at = places.setdefault((op, r.record_type), [])
            if r.index not in at:
                at.append(r.index)
    country = F.col(refs.country_col) if refs.country_col else F.lit(refs.country)

    def member(r: CompiledRule) -> Column:
        """Whether the value is one of the reference's; null where there is no reference."""
        if r.op not in checks or checks[r.op][1] is None:
            return F.lit(None).cast("boolean")
        name = checks[r.op][0]
        found = F.coalesce(f"__{name}_{places[r.op, r.record_type].index(r.index)}", F.lit(False))
        return F.when(F.col(f"__{name}_on"), found)

    numbers: dict[str, list[Column]] = {}
    for i, r in enumerate(rules):
        bad = _violated(r, country, member(r))
        if rule_bits is not None:
            word = F.get(rule_bits, F.lit(i // _WORD))
            bad = F.coalesce(word.bitwiseAND(F.lit(1 << i % _WORD).cast("long")) != 0, F.lit(False)) & bad
        numbers.setdefault(r.record_type, []).append(F.when(bad, F.lit(i)))
    none = F.array().cast("array<int>")
    violated = _by_type({t: F.array_compact(F.array(*n)) for t, n in numbers.items()})
    return df.select(*records.columns, (none if violated is None else F.coalesce(violated, none)).alias("violated"))


def rule_entries(spark: SparkSession, compiled: CompiledRules) -> DataFrame:
    """One row per compiled rule: its ``number`` and the constant part of its log entries.

    ``__text_i`` is the text before the i-th logged field and ``__at_i`` that field's position, so a description is a plain
    concatenation, whatever the rules are; a rule with fewer fields has nulls at the end.
    """
    width = max([len(r.fields) for r in compiled.rows], default=0)
    rows = []
    for i, r in enumerate(compiled.rows):
        texts = [("|" if j else f"{r.description};") + f"{name}:" for j, (_, name) in enumerate(r.fields)] or [f"{r.description};"]
        at = [j for j, _ in r.fields]
        rows.append((i, r.index, r.op, r.severity, r.type, r.identifier, r.recommendation,
                     *texts, *[None] * (max(width, 1) - len(texts)), *at, *[None] * (width - len(at))))
    return spark.createDataFrame(rows, ", ".join([
        "number int, field_index int, operator string, errorseverity string, type string, erroridentifier string, recommendation string",
        *[f"__text_{j} string" for j in range(max(width, 1))], *[f"__at_{j} int" for j in range(width)]]))


def numbered_violations(checked: DataFrame, compiled: CompiledRules, line_col: str = "line") -> DataFrame:
    """``violations_of`` with the ``number`` of the rule."""
    keep = [c for c in checked.columns if c not in ("violated", "fields")]
    rules = rule_entries(checked.sparkSession, compiled)
    found = checked.where(F.size("violated") > 0).select(
        *keep, parts_of(F.col(line_col)).alias("__parts"), F.explode("violated").alias("__number"))
    none, text = F.lit(""), []
    for j in range(sum(c.startswith("__text_") for c in rules.columns)):
        text.append(F.coalesce(f"__text_{j}", none))
        if f"__at_{j}" in rules.columns:
            text.append(F.coalesce(F.get("__parts", F.col(f"__at_{j}")), none))
    return found.join(F.broadcast(rules), F.col("__number") == F.col("number")).select(  # the file's compiled rules
        *keep, "number", "field_index", "operator", F.get("__parts", F.col("field_index")).alias("value"), "errorseverity", "type",
        F.concat(*text).alias("errordescription"), "erroridentifier", "recommendation")


def violations_of(checked: DataFrame, compiled: CompiledRules, line_col: str = "line") -> DataFrame:
    """One row per (line, violated rule): the line's columns plus the rule's log fields.

    Adds ``field_index``, ``operator``, ``value``, ``errorseverity``, ``type``, ``errordescription``
    (``description;name:value|...`` over the rule's field map), ``erroridentifier`` and ``recommendation``.
    """
    return numbered_violations(checked, compiled, line_col).drop("number")


def is_error(compiled: CompiledRules) -> Column:
    """How many of a line's violations are of type ``Error``."""
    errors = [i for i, r in enumerate(compiled.rows) if r.type == K.ERROR_TYPE]
    return F.size(F.filter("violated", lambda n: n.isin(errors))) if errors else F.lit(0)


def check_records(records: DataFrame, compiled: CompiledRules, refs: References) -> DataFrame:
    """The violations of parsed records: one row per (line, violated rule)."""
    return violations_of(check_lines(records, compiled, refs), compiled)


# --------------------------------------------------------------------------- H12 / C11

def check_and_split(lines: DataFrame, compiled: CompiledRules, refs: References,
                    line_col: str = "line") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(violations, clean, failed)`` of record lines.

    A line with any violation, of any Type, warnings included, is removed.  The checks are a function of the line, so
    identical lines go together; the split is a filter on the line's flag, and no line is looked up among the failed ones.
    """
    checked = check_lines(parse_records(lines, line_col), compiled, refs)
    return (violations_of(checked, compiled, line_col), checked.where(F.size("violated") == 0).select(*lines.columns),
            checked.where(F.size("violated") > 0).select(*lines.columns))


def send_log_rows(violations: DataFrame, orchestrator_id: str, stage: str, region: str, country: str,
                  source: str, component: str, objectname: str, run_date: str, now=None, also: tuple[str, ...] = ()) -> DataFrame:
    """Validation-log rows of a record-file check (I4); ``also``: columns that are kept beside the log's."""
    ts = F.localtimestamp() if now is None else F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return violations.select(
        F.lit(orchestrator_id).alias("orchestratorid"), F.lit(stage).alias("stage"),
        F.lit(region).alias("region"), F.lit(country).alias("country"), F.lit(source).alias("source"),
        F.lit(component).alias("sourcecomponent"), F.lit(objectname).alias("objectname"),
        "errorseverity", "type", "errordescription", "erroridentifier",
        F.lit(run_date).cast("date").alias("createddttm"), ts.alias("recordtimestamp"), "recommendation", *also,
    )


def bind_reference_query(text: str, country: str, region: str, component: str) -> str:
    """Reference queries bind country/region/component lower-cased."""
    return bind_name(text, country=country, region=region, component=component)


def reference_frame(spark: SparkSession, queries: list[str], columns: list[str], country: str, region: str,
                    component: str) -> DataFrame | None:
    """D7 reference data from the rules' own queries: the distinct query texts, placeholders bound
    (lower-cased), combined with UNION ALL by position, renamed to ``columns`` and deduplicated.
    None when no rule carries a query (the check is then skipped, as with an empty reference)."""
    if not queries:
        return None
    frames = [spark.sql(bind_reference_query(q, country, region, component)) for q in queries]
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.toDF(*columns).distinct()


def baseline_from_rules(spark: SparkSession, compiled: CompiledRules, run_date: str, country: str, region: str,
                        vendor: str) -> DataFrame:
    """E5: the file's baseline count from its BASELINEQUERY rule, as a one-row ``baseline`` frame.

    The query text is bound (date, date suffix, lower-cased country / region / vendor) and run as
    Spark SQL; it may be a UNION ALL of counts, which are summed.  Exactly one distinct baseline
    query must be in scope.
    """
    qs = compiled.baseline_queries
    if len(qs) != 1:
        raise ValueError(f"expected one baseline query for the file, found {len(qs)}")
    df = spark.sql(bind_query(qs[0], run_date, country, region, vendor))
    return df.agg(F.coalesce(F.sum(F.col(f"`{df.columns[0]}`")), F.lit(0)).cast("long").alias("baseline"))


def unknown_rule_report(lines: DataFrame, compiled: CompiledRules, line_col: str = "line") -> DataFrame:
    """Each rule whose operator has no check, with the number of records of its type it leaves unchecked."""
    rules = lines.sparkSession.createDataFrame(
        [(r["AdditionalCondition"], r["Operator"], str(r["ObjectField"])) for r in compiled.unknown],
        "record_type string, operator string, object_field string")
    counts = (lines.groupBy(F.get(F.split(F.col(line_col), r'\|"', -1), 0).alias("record_type"))
              .agg(F.count(F.lit(1)).alias("__n")))
    return rules.join(counts, "record_type", "left").select(
        "record_type", "operator", "object_field", F.coalesce("__n", F.lit(0)).cast("long").alias("n_unchecked"))
