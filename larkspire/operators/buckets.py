"""Search-style aggregations: a nested request, one aggregation at the top, becomes a DataFrame.

    {"by": {"terms": {"field": "status", "size": 10}, "aggs": {"mean": {"avg": {"field": "score"}}}}}
Buckets: terms, histogram, date_histogram, range. Metrics: avg, sum, min, max, value_count (count), cardinality, stats,
extended_stats, percentiles; alone or under a bucket. A metric without documents is null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERCENTS = (1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0)
#: Empty buckets are filled in only over at most so many.
MAX_FILLED = 1_000_000
#: Columns of _spread(): a value's place among its document's, and the values side by side.
PLACE, ZIPPED = "__place", "__values"
UNITS_MS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def number_text(x: float) -> str:
    """Integral numbers without decimals."""
    return str(int(x)) if float(x) == int(x) else repr(float(x))


def _field(df: DataFrame, spec: dict) -> Column:
    name = spec.get("field")
    if name is None or name not in df.columns:
        raise ValueError(f"aggregation field '{name}' not found")
    return F.col(f"`{name}`")


def _metric(df: DataFrame, name: str, kind: str, spec: dict) -> list[Column]:
    c = _field(df, spec)
    if ZIPPED in df.columns:  # a document's rows are its values: other fields count in the first
        c = F.col(f"{ZIPPED}.`{spec['field']}`") if _listed(df, spec) else F.when(F.col(PLACE) == 0, c)
    simple: dict[str, Callable[[Column], Column]] = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "value_count": F.count, "count": F.count}
    if kind in simple:
        return [simple[kind](c).alias(name)]
    if kind == "cardinality":
        return [(F.count_distinct(c) if spec.get("exact") else F.approx_count_distinct(c, spec.get("rsd", 0.02))).alias(name)]
    if kind in ("stats", "extended_stats"):
        parts = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count, "avg": F.avg}
        if kind == "extended_stats":
            parts |= {"variance_population": F.var_pop, "std_deviation_population": F.stddev_pop}
        return [f(c).alias(f"{name}_{k}") for k, f in parts.items()]
    if kind == "percentiles":
        value = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        at = [float(p) for p in spec.get("percents", PERCENTS)]
        one = F.percentile if spec.get("exact") else lambda v, p: F.percentile_approx(v, p, spec.get("accuracy", 10_000))
        return [one(value, F.lit(p / 100)).alias(f"{name}_p{number_text(p)}") for p in at]
    return []


def _listed(df: DataFrame, spec: dict) -> bool:
    return spec.get("field") in df.columns and isinstance(df.schema[spec["field"]].dataType, T.ArrayType)


def _spread(df: DataFrame, requests: dict) -> DataFrame:
    """df with a row for each value if metrics ask for fields of several values: all such fields side by side, each value once."""
    specs = [(kind, spec) for name, body in requests.items() for kind, spec, _ in [_only(name, body)]]
    lists = sorted({spec["field"] for kind, spec in specs if kind in METRICS and _listed(df, spec)})
    if not lists:
        return df
    values = [F.array(F.lit(1)).alias(PLACE), *(F.coalesce(F.col(f"`{x}`"), F.array().cast(df.schema[x].dataType)).alias(x) for x in lists)]
    return df.select("*", F.posexplode(F.arrays_zip(*values)).alias(PLACE, ZIPPED))


def _metrics(df: DataFrame, subs: dict) -> list[Column]:
    """Columns of the aggregations under a bucket; those that aren't metrics are null."""
    out = []
    for name, request in subs.items():
        kind, spec, _ = _only(name, request)
        out += _metric(df, name, kind, spec) if kind in METRICS else [F.any_value(F.lit(None).cast("double")).alias(name)]
    return out


METRICS = ("avg", "sum", "min", "max", "value_count", "count", "cardinality", "stats", "extended_stats", "percentiles")


def _only(name: str, request: dict) -> tuple[str, dict, dict]:
    subs = request.get("aggs") or request.get("aggregations") or {}
    kinds = [k for k in request if k not in ("aggs", "aggregations")]
    if len(kinds) != 1:
        raise ValueError(f"aggregation '{name}' needs exactly one kind")
    return kinds[0], request[kinds[0]], subs


def aggregate(df: DataFrame, request: dict) -> DataFrame:
    if len(request) != 1:
        raise ValueError("supports only a single top-level aggregation")
    (name, body), *_ = request.items()
    kind, spec, subs = _only(name, body)
    if not isinstance(spec, dict):
        raise ValueError(f"aggregation '{name}' needs a request")
    if kind in METRICS:
        spread = _spread(df, request)
        return spread.agg(*_metric(spread, name, kind, spec))
    made = {"terms": terms, "histogram": histogram, "date_histogram": date_histogram, "range": ranges}.get(kind)
    if made is None:
        raise ValueError(f"unsupported bucket type '{kind}'")
    return made(df, spec, subs)


def _counted(df: DataFrame, key: str, subs: dict) -> DataFrame:
    df = _spread(df, subs)
    documents = F.count_if(F.col(PLACE) == 0) if ZIPPED in df.columns else F.count("*")
    return df.groupBy(key).agg(documents.alias("doc_count"), *_metrics(df, subs))


def _needed(spec: dict, *names: str) -> list:
    missing = [n for n in names if n not in spec]
    if missing:
        raise ValueError(f"the aggregation needs '{missing[0]}'")
    return [spec[n] for n in names]


def terms(df: DataFrame, spec: dict, subs: dict) -> DataFrame:
    """<field>, doc_count, metrics: the `size` (10) first buckets by `order` (most documents), equal ones by key.

    Documents without a value are left out unless `missing` names one for them; of several values each counts once.
    size None gives all buckets.
    """
    c = _field(df, spec)
    field = spec["field"]
    if _listed(df, spec):
        # The other columns are kept for metrics; the key stands for one value of each document at a time.
        rows = df.withColumn("__key", F.explode_outer(F.array_distinct(c)))
    else:
        rows = df.withColumn("__key", c)
    if "missing" in spec:
        rows = rows.withColumn("__key", F.coalesce("__key", F.lit(spec["missing"]).cast(rows.schema["__key"].dataType)))
    out = _counted(rows.where(F.col("__key").isNotNull()), "__key", subs)
    if (least := spec.get("min_doc_count", 1)) > 1:
        out = out.where(F.col("doc_count") >= least)
    order = []
    for by, way in (spec.get("order") or {"_count": "desc"}).items():
        column = F.col({"_count": "doc_count", "_key": "__key"}.get(by, f"`{by}`"))
        order.append(column.desc() if way == "desc" else column.asc())
    size = spec.get("size", 10)
    if size is not None:
        out = out.orderBy(*order, "__key").limit(size)
    return out.withColumnRenamed("__key", field)


def histogram(df: DataFrame, spec: dict, subs: dict, value: Callable[[Column], Column] = lambda v: v) -> DataFrame:
    """bucket (double, its lower end), doc_count, metrics. With min_doc_count 0 empty buckets between others are there, too."""
    interval, offset = float(_needed(spec, "interval")[0]), float(spec.get("offset", 0))
    if interval <= 0:
        raise ValueError("a histogram needs a positive interval")

    def lower_end(v: Column) -> Column:
        """Null for what has no bucket."""
        v = v.cast("double")
        there = v.isNotNull() & ~F.isnan(v)
        if bounds := spec.get("hard_bounds"):
            there = there & v.between(F.lit(float(bounds["min"])), F.lit(float(bounds["max"])))
        return F.when(there, F.floor((v - F.lit(offset)) / F.lit(interval)) * F.lit(interval) + F.lit(offset))

    c = _field(df, spec)
    if _listed(df, spec):  # a document counts once in each bucket that any of its values is in
        rows = df.withColumn("bucket", F.explode(F.array_distinct(F.array_compact(F.transform(c, lambda x: lower_end(value(x)))))))
    else:
        made = lower_end(value(c))
        rows = df.withColumn("bucket", made).where(made.isNotNull())
    out = _counted(rows, "bucket", subs)
    if "min_doc_count" in spec and spec["min_doc_count"] == 0:
        ends = out.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).first()
        if ends["a"] is not None:
            n = round((ends["b"] - ends["a"]) / interval) + 1
            if n > MAX_FILLED:
                raise ValueError(f"a histogram of {n} buckets; at most {MAX_FILLED} are filled in")
            every = df.sparkSession.range(n).select(F.col("id").alias("__n"))
            numbered = out.withColumn("__n", F.round((F.col("bucket") - F.lit(ends["a"])) / F.lit(interval)).cast("bigint"))
            filled = every.join(numbered, "__n", "left")
            out = filled.withColumns({"bucket": F.col("__n") * F.lit(interval) + F.lit(ends["a"]), "doc_count": F.coalesce("doc_count", F.lit(0))}).drop("__n")
    elif spec.get("min_doc_count", 1) > 1:
        out = out.where(F.col("doc_count") >= spec["min_doc_count"])
    return out


def milliseconds(text: str) -> int:
    m = re.fullmatch(r"(-?\d+)(ms|s|m|h|d)", text.strip())
    if not m:
        raise ValueError(f"not a fixed interval: '{text}'")
    return int(m[1]) * UNITS_MS[m[2]]


def date_histogram(df: DataFrame, spec: dict, subs: dict) -> DataFrame:
    """As histogram; bucket is the lower end in milliseconds since 1970 as a double."""
    own = {k: v for k, v in spec.items() if k in ("min_doc_count", "hard_bounds", "field")}
    interval = milliseconds(_needed(spec, "fixed_interval")[0])
    return histogram(df, own | {"interval": interval, "offset": milliseconds(spec.get("offset", "0ms"))}, subs, lambda v: F.unix_micros(v.cast("timestamp")) / F.lit(1000.0))


def range_key(r: dict) -> str:
    ends = (number_text(r[k]) if r.get(k) is not None else "*" for k in ("from", "to"))
    return r.get("key") or "-".join(ends)


def ranges(df: DataFrame, spec: dict, subs: dict) -> DataFrame:
    """bucket (the range's key), doc_count, metrics, a row for each range, in order: from included, to not; they may overlap."""
    c, wanted = _field(df, spec), _needed(spec, "ranges")[0]

    def inside(v: Column, r: dict) -> Column:
        v = v.cast("double")
        out = v.isNotNull()
        if r.get("from") is not None:
            out = out & (v >= F.lit(float(r["from"])))
        if r.get("to") is not None:
            out = out & (v < F.lit(float(r["to"])))
        return out

    def holds(r: dict) -> Column:
        return F.exists(c, lambda v: inside(v, r)) if _listed(df, spec) else inside(c, r)

    found = [F.when(holds(r), F.lit(i)) for i, r in enumerate(wanted)]
    rows = df.withColumn("__range", F.explode(F.array_compact(F.array(*found))))
    out = _counted(rows, "__range", subs)
    named = df.sparkSession.createDataFrame([(i, range_key(r)) for i, r in enumerate(wanted)], "__range int, bucket string")
    joined = named.join(out, "__range", "left").orderBy("__range")  # as many rows as the request has ranges
    return joined.withColumn("doc_count", F.coalesce("doc_count", F.lit(0))).drop("__range")
