"""Regional data pipeline and data-quality engine expressed as Spark DataFrame operators.

Sub-packages:
  sources    -- readers: file listings, record files, delimited loads, dated views, reference tables
  sinks      -- writers: append, rerun-safe slice replacement, exports, record files
  functions  -- Column-level helpers (placeholders, prefix regex, calendar dates, log fields, rounding)
  operators  -- DataFrame -> DataFrame operators (history, rules, records, thresholds, render, ...)
  plans      -- parameterised SQL jobs and the registered queries over the shared test tables
  streaming  -- Structured Streaming landing of files
"""

__version__ = "0.1.0"
