"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

Each source gets a mean repetition rate: its target weight times the total, over the rows it has. A document's number of
copies is the value at which the Poisson distribution with that mean passes a uniform number that a seeded hash of the
document's id gives; the document is exploded by that number, and all copies are sorted by a seeded hash of id
and copy, which is a global shuffle and the only exchange of texts. Sums of rows by source are combined before they are moved. The table of rates
has a row per source; its size is measured, and up to SENT_BYTES it is sent to every task. A larger one is joined by source and one of SALTS parts of the
documents, so that a hot source doesn't meet in one task.

Defined results: a null source is a source of its own; a null id counts as the empty text; texts may be null, empty or of
any length. Repeated rows draw the same number, and their copies' order among each other is open. A source with
weight 0 vanishes, one that ``weights`` doesn't name too. An empty table gives an empty one. Further columns of the
documents pass through; the names given by ``copy_col`` and ``key_col`` and any that begins with ``__mix`` are the operator's own, and columns
of the documents with those names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import save

_UNIT = float(1 << 52)
SENT_BYTES, SALTS = 16 << 20, 64


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the key's md5."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(_UNIT)


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k from 0 on, so far that what is left is below the uniform numbers' grain."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")

    def mass(k: Column) -> Column:
        logs = F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), lambda s, i: s + F.ln(F.greatest(i, F.lit(1)).cast("double")))
        return F.exp(k * F.ln(rate) - rate - logs)

    masses = F.transform(F.sequence(F.lit(0), last), mass)
    return F.when(rate > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(masses, 1, k + 1), F.lit(0.0), lambda s, x: s + x))).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None, exponent: float = 0.5, total: int | None = None) -> DataFrame:
    """Per source: __mix_source and __mix_rate. ``weights`` has columns source and weight, of any scale; without it a source's
    weight is its rows to the power ``exponent``. ``total``: copies aimed at, by default as many as there are rows."""
    n = docs.groupBy(F.col(source_col).alias("__mix_source")).agg(F.count(F.lit(1)).alias("__mix_rows"))
    if weights is None:
        n = n.withColumn("__mix_weight", F.pow(F.col("__mix_rows").cast("double"), F.lit(exponent)))
    else:
        w = weights.select(F.col("source").alias("__mix_named"), F.col("weight").cast("double").alias("__mix_weight"))
        n = n.join(w, F.col("__mix_source").eqNullSafe(F.col("__mix_named"))).drop("__mix_named")
    all_ = n.agg(F.sum("__mix_weight").alias("__mix_w"), F.sum("__mix_rows").alias("__mix_n"))
    aim = F.col("__mix_n").cast("double") if total is None else F.lit(float(total))
    # one row beside a row per source
    return n.join(F.broadcast(all_)).select("__mix_source", (F.col("__mix_weight") / F.col("__mix_w") * aim / F.col("__mix_rows")).alias("__mix_rate"))


def with_rates(docs: DataFrame, r: DataFrame, ident: Column, source_col: str, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``docs`` with their source's distribution; rows whose source has none go. No text is moved if the table of rates is small."""
    r = save(docs.sparkSession, r, "rates")
    size = r.agg(F.sum(8 * F.size("__mix_cdf") + F.coalesce(F.octet_length(F.col("__mix_source").cast("string")), F.lit(0)) + 32)).first()[0] or 0
    same = F.col(source_col).eqNullSafe(F.col("__mix_source"))
    if size <= sent_bytes:
        return docs.join(F.broadcast(r), same)
    part = F.pmod(F.xxhash64(ident), F.lit(SALTS)).cast("int")
    r = r.withColumn("__mix_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return docs.withColumn("__mix_own", part).join(r, same & (F.col("__mix_own") == F.col("__mix_part")))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: DataFrame | None = None, exponent: float = 0.5, total: int | None = None, seed: str = "mix-1", copy_col: str = "copy", key_col: str = "mix_key", sent_bytes: int = SENT_BYTES
) -> DataFrame:
    """The copies of ``docs`` in shuffled order, each with ``copy_col`` (from 1) and ``key_col``, the hash that it is sorted by."""
    docs = docs.drop(copy_col, key_col)
    r = rates(docs, source_col, weights, exponent, total).select("__mix_source", poisson_cdf(F.col("__mix_rate")).alias("__mix_cdf"))
    ident = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    drawn = with_rates(docs.withColumn("__mix_u", uniform(ident)), r, ident, source_col, sent_bytes)
    times = F.size(F.filter("__mix_cdf", lambda c: c <= F.col("__mix_u")))
    return (
        drawn.withColumn("__mix_times", times).where("__mix_times > 0")
        .withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
        .withColumn(key_col, F.md5(F.concat(ident, F.lit("|"), F.col(copy_col).cast("string"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns], copy_col, key_col)
        .orderBy(key_col)
    )


ORACLE = f"""
WITH n AS (SELECT source, count(*) AS rows, pow(count(*)::DOUBLE, 0.5) AS weight FROM documents GROUP BY source),
a AS (SELECT sum(weight) AS w, sum(rows)::DOUBLE AS n FROM n),
r AS (SELECT source, weight / a.w * a.n / rows AS rate FROM n, a),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS k FROM r),
p AS (SELECT source, k, exp(k * ln(rate) - rate - coalesce((SELECT sum(ln(i::DOUBLE)) FROM range(1, k + 1) t(i)), 0)) AS mass FROM k),
c AS (SELECT source, sum(mass) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
l AS (SELECT source, list(cdf ORDER BY cdf) AS cdfs FROM c GROUP BY source),
u AS (SELECT d.*, ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {_UNIT} AS u FROM documents d),
t AS (SELECT u.*, len(list_filter(cdfs, lambda x: x <= u.u)) AS times FROM u JOIN l ON u.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || copy) AS mix_key
FROM (SELECT *, unnest(range(1, times + 1)) AS copy FROM t WHERE times > 0)
"""
