"""Mixing sources to target weights by Poisson replication and a global shuffle.  Native: DataFrame functions only.

With n_s documents in source s, n in all, and target weights w_s (summing to
one) over an output of ``scale`` * n documents, a document of source s is
expected rate_s = w_s * scale * n / n_s times.  Its number of copies is
the inverse of the Poisson distribution of that mean at a uniform number
made from the hash of its id, so a rerun, a retry or another partitioning gives
the same copies, and no document's number depends on another's.  A rate over
``STEP`` is drawn as a sum of independent draws of equal smaller means, which
keeps exp(-rate) far from underflow.

Default weights are n_s ** ``temperature`` (normalised): 1 keeps the natural
shares, 0 gives every source the same.  ``weights`` (source -> weight) replaces them;
sources not named get none.

The rates of all sources are one small row each.  They are broadcast while there
are at most ``BROADCAST_SOURCES``; beyond that rows are salted and
joined by shuffle, so a source with a third of all rows is split either way.
The copies are ordered by a hash of (seed, copy, id): a uniform global
shuffle by range partitioning, which spreads sources and copies evenly.

Defined results: a null source is a source; a null id is drawn by the hash of its
text; rows with equal ids get equal counts (each is replicated); an empty table gives none; extra columns stay
(names beginning with ``_mx_`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import text_or_empty

TEMPERATURE = 0.5
STEP = 32.0
BROADCAST_SOURCES = 10_000
SALTS = 32


def source_rates(docs: DataFrame, source: str = "source", temperature: float = TEMPERATURE, scale: float = 1.0,
                 weights: dict[str, float] | None = None) -> DataFrame:
    """``_mx_source, rate`` per source."""
    sizes = docs.groupBy(F.col(source).alias("_mx_source")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    if weights is None:
        weighed = sizes.withColumn("w", F.pow("n", F.lit(float(temperature))))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.lit(None).cast("map<string,double>")
        weighed = sizes.withColumn("w", F.coalesce(named[F.col("_mx_source")].cast("double"), F.lit(0.0)))
    total = weighed.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    if not total["w"]:
        return weighed.select("_mx_source", F.lit(0.0).alias("rate"))
    return weighed.select("_mx_source", (F.col("w") / F.lit(total["w"]) * F.lit(scale * total["n"]) / F.col("n")).alias("rate"))


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... copies for a mean, until the rest is below double precision."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 16).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda acc: acc["all"])


def replicated(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix",
               temperature: float = TEMPERATURE, scale: float = 1.0, weights: dict[str, float] | None = None) -> DataFrame:
    """All columns of ``docs``, ``copy`` (from 0) and ``shuffle_key``, one row per copy, in global order of the key.

    Where ``docs`` has a column of such a name, that column stays and the added one gets a leading underscore.
    """
    rates = source_rates(docs, source, temperature, scale, weights)
    draws = F.greatest(F.ceil(F.col("rate") / F.lit(STEP)), F.lit(1)).cast("int")
    rates = rates.select("_mx_source", draws.alias("_mx_draws"), poisson_table(F.col("rate") / draws).alias("_mx_table"))
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(text_or_empty(text).cast("binary")))
    named = docs.withColumn("_mx_name", name)
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        joined = named.join(F.broadcast(rates), named[source].eqNullSafe(rates["_mx_source"]))
    else:
        spread = rates.withColumn("_mx_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = named.withColumn("_mx_salt", F.pmod(F.xxhash64("_mx_name"), F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, salted[source].eqNullSafe(spread["_mx_source"]) & (salted["_mx_salt"] == spread["_mx_part"]))
    below = F.expr("""aggregate(sequence(1, _mx_draws), 0, (n, j) -> n + size(filter(_mx_table, c -> c <=
        cast(conv(substring(md5(cast(concat('{seed}:', j, ':', _mx_name) as binary)), 1, 13), 16, 10) as bigint) / {top})))
        """.format(seed=seed.replace("\\", "\\\\").replace("'", "\\'"), top=f"{float(1 << 52):.1f}D"))
    drawn = joined.withColumn("_mx_copies", below).where("_mx_copies > 0")
    copies = drawn.withColumn("_mx_copy", F.explode(F.sequence(F.lit(0), F.col("_mx_copies") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(seed + "-order"), "_mx_copy", "_mx_name").cast("binary"))
    columns, taken = [F.col(f"`{c}`") for c in docs.columns], {c.lower() for c in docs.columns}
    ordered = copies.withColumn("_mx_key", key).orderBy("_mx_key", "_mx_copy")
    return ordered.select(*columns, *[F.col(c).alias(f"_{name}" if name in taken else name)
                                      for c, name in (("_mx_copy", "copy"), ("_mx_key", "shuffle_key"))])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The copies with the columns of ``docs`` only."""
    return replicated(docs, **options).select(*[F.col(f"`{c}`") for c in docs.columns])


# For rates up to STEP (one draw per document).
ORACLE = """
with sizes as (select source, count(*)::double as n from documents group by source),
rates as (select source, pow(n, 0.5) / sum(pow(n, 0.5)) over () * sum(n) over () / n as rate from sizes),
steps as (select source, rate, unnest(range(0, 120)) as k from rates),
cdf as (select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as c from steps),
drawn as (select doc_id, source, ('0x' || substr(md5('mix:1:' || doc_id), 1, 13))::bigint / 4503599627370496.0::double as u
          from documents),
copies as (select d.doc_id, count(*) as n from drawn d join cdf on d.source is not distinct from cdf.source and cdf.c <= d.u
           group by d.doc_id)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::int as copy,
       md5('mix-order:' || c.copy || ':' || d.doc_id) as shuffle_key
from documents d join (select doc_id, unnest(range(0, n)) as copy from copies) c using (doc_id)
"""
