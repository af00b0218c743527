"""Mixing sources to target weights by Sainte-Laguë apportionment.

Only DataFrame and SQL functions are used. The token budget is cut into equal
blocks. Blocks go to the sources, and each source's blocks to its shards, by the
highest quotients target / (2 k + 1); a seeded permutation of block numbers then
says which blocks of a shard are read.

Which quotients compete is bounded before they are made: for n seats among S
parties, the final divisor lies within a relative S / n of the even one, so a
party with the fair share q gets at least q - q S / n - 1 and at most
q + q S / n + 1 seats. Only the seats in between, about 4 S in all, are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import WORD_RE, materialize
from prismset.session import table

#: Weights of the sources in code point order, repeated.
WEIGHTS = (3, 1, 2)
#: Tokens to take, as a share of all tokens, and how often a token may be taken.
SHARE = 1.5
MOST = 2
#: Rows of a shard (more only where a source would get over MAX_SHARDS), and the
#: largest block.
SHARD_ROWS = 4096
MAX_SHARDS = 4096
BLOCK_TOKENS = 256
#: A prime above any number of blocks in a shard, so it is coprime to all of them.
STEP = 2147483647
SEED = 42


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, n_rows, weight, target) from (source, source_size, n_rows).

    The targets fill up like water: sources sorted by cap over weight are capped
    as long as the total with that level does not exceed the budget.
    """
    spark = sources.sparkSession
    cases = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return spark.sql(
        f"""
        WITH w AS (
          SELECT *, CAST({most} * source_size AS DOUBLE) AS cap,
                 CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(weights)} {cases} END AS weight,
                 CAST({share} AS DOUBLE) * sum(source_size) OVER () AS budget
          FROM {{sources}}),
        r AS (SELECT *, cap / weight AS level FROM w),
        g AS (
          SELECT *, sum(cap) OVER (ORDER BY level, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)
                 + level * coalesce(sum(weight) OVER (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) <= budget AS full
          FROM r),
        l AS (
          SELECT *, (budget - coalesce(sum(CASE WHEN full THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT full THEN weight END) OVER () AS water FROM g)
        SELECT source, source_size, n_rows, weight, CASE WHEN full THEN cap ELSE weight * water END AS target FROM l
        """,
        sources=sources,
    )


def _seats(parties: DataFrame, by: str, key: str) -> DataFrame:
    """Sainte-Laguë seats: adds ``seats`` to (by..., key, share, n) rows.

    ``share`` is a party's weight, ``n`` the seats to give within its group.
    """
    spark = parties.sparkSession
    order = "source ASC NULLS LAST" if key == "source" else key
    fair = spark.sql(
        f"""
        SELECT *, share * n / total AS q, least(n, CAST(CASE WHEN n >= 2 * many THEN ceil(share / total * many) + 1 ELSE n END AS BIGINT)) AS reach
        FROM (SELECT *, sum(share) OVER ({by}) AS total, count_if(share > 0) OVER ({by}) AS many FROM {{p}}) WHERE share > 0
        """,
        p=parties,
    )
    span = spark.sql("SELECT *, greatest(0, CAST(floor(q) AS BIGINT) - reach) AS low, least(n, CAST(ceil(q) AS BIGINT) + reach) AS high FROM {f}", f=fair)
    rank = by + (" " if by else "") + f"ORDER BY share / (2 * k + 1) DESC, {order}, k"
    won = spark.sql(
        f"""
        SELECT source, {'' if key == 'source' else key + ','} count(*) AS more FROM (
          SELECT *, row_number() OVER ({rank}) AS place FROM (
            SELECT *, explode(sequence(low, high - 1)) AS k FROM (SELECT *, n - sum(low) OVER ({by}) AS open FROM {{s}}) WHERE high > low))
        WHERE place <= open GROUP BY ALL
        """,
        s=span,
    )
    on = F.col("s.source").eqNullSafe(F.col("w.source"))
    if key != "source":
        on = on & (F.col(f"s.{key}") == F.col(f"w.{key}"))
    return span.alias("s").join(won.alias("w"), on, "left").select("s.source", *([] if key == "source" else [f"s.{key}"]), (F.col("s.low") + F.coalesce("w.more", F.lit(0))).alias("seats"))


def _placed(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, most: int, seed: int, whole_rows: bool) -> DataFrame:
    """Rows (row, doc_id, source, size, block, source_size, target, start, whole, blocks, extra, turn).

    ``row`` holds all columns of ``df`` if ``whole_rows``. In its shard, ordered by a seeded key, a
    document covers the words from ``start``; the shard is read ``whole`` times
    and once more in those of its ``blocks`` that ``turn`` and ``extra`` select.
    """
    spark = df.sparkSession

    def sized(row: list) -> DataFrame:
        return df.select(
            *row,
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"),
        ).withColumn("key", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))

    def place(docs: DataFrame) -> DataFrame:
        return spark.sql(
            """
            SELECT d.*, s.block, s.source_size, s.target, s.quota, CAST(conv(substr(d.key, 1, 8), 16, 10) AS BIGINT) % s.shards AS shard
            FROM {d} d JOIN {s} s ON d.source <=> s.source
            """,
            d=docs,
            s=sources,
        )

    docs = materialize(sized([]), "sizes")
    sources = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), weights, share, most)
    sources = spark.sql(
        f"""
        SELECT *, greatest(1, least({BLOCK_TOKENS}, sum(source_size) OVER () div (256 * sum(shards) OVER ()))) AS block, sum(target) OVER () AS all_target
        FROM (SELECT *, least({MAX_SHARDS}, (n_rows + {SHARD_ROWS - 1}) div {SHARD_ROWS}) AS shards FROM {{s}})
        """,
        s=sources,
    )
    sources = materialize(sources, "sources")
    quota = _seats(sources.select("source", F.col("target").alias("share"), F.floor(F.col("all_target") / F.col("block") + 0.5).alias("n")), "", "source")
    sources = materialize(sources.alias("s").join(quota.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source")), "left").select("s.*", F.coalesce("q.seats", F.lit(0)).alias("quota")), "quota")
    shards = place(docs).groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.min("quota").alias("n"), F.min("block").alias("block"))
    seats = _seats(shards.select("source", "shard", F.col("shard_size").cast("double").alias("share"), "n"), "PARTITION BY source", "shard")
    plan = spark.sql(
        f"""
        SELECT source, shard, whole, blocks, CASE WHEN whole < {most} THEN least(blocks, CAST(floor((want - whole * shard_size) / block + 0.5) AS BIGINT)) ELSE 0 END AS extra,
               CAST(conv(substr(md5(concat('{seed}|', coalesce(source, ''), '|', shard)), 1, 8), 16, 10) AS BIGINT) % blocks AS turn
        FROM (SELECT h.*, e.seats * h.block AS want, least({most}, e.seats * h.block div h.shard_size) AS whole, (h.shard_size + h.block - 1) div h.block AS blocks
              FROM {{h}} h JOIN {{e}} e ON h.source <=> e.source AND h.shard = e.shard WHERE h.shard_size > 0)
        """,
        h=shards,
        e=seats,
    )
    full = sized([F.struct("*").alias("row")]) if whole_rows else docs
    return spark.sql(
        """
        SELECT p.*, l.whole, l.blocks, l.extra, l.turn
        FROM (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM {p}) p
        LEFT JOIN {l} l ON p.source <=> l.source AND p.shard = l.shard
        """,
        p=place(full),
        l=materialize(plan, "plan"),
    )


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken.

    ``size`` counts the words of the text (0 for null); ``target`` is the source's
    share of the budget; ``taken`` the words the mix reads of this document,
    repeats counted, never over ``most`` times its size. A null source is a source
    of its own, last in order. A null id is ordered as the empty text; repeated
    rows are rows like others. An empty table gives an empty result, a table
    without words takes none. Reruns agree whatever the partitioning.
    """
    return _placed(df, id_col, text_col, source_col, weights, share, most, seed, False).selectExpr(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        f"""coalesce(whole * size + CASE WHEN size = 0 THEN 0 ELSE
              aggregate(sequence(start div block, (start + size - 1) div block), 0L, (a, j) -> a +
                CASE WHEN (j * {STEP} + turn) % blocks < extra THEN least(start + size, (j + 1) * block) - greatest(start, j * block) ELSE 0L END) END, 0L) AS taken""",
    )


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself, in the columns of ``df``: the rows of ``mix`` put into effect.

    A document appears once for every whole pass over its shard and once more
    with the words of its selected blocks, with the white space that follows them
    (``length_col``, if ``df`` has it, then counts that text). Documents of which
    nothing is taken are left out, those without words too.
    """
    rows = _placed(df, id_col, text_col, source_col, weights, share, most, seed, True).where("size > 0")
    # a word with the white space after it; white space before the first word goes with it
    rows = rows.selectExpr(
        "row",
        "whole",
        f"""filter(transform(sequence(start div block, (start + size - 1) div block), j -> struct(
              greatest(start, j * block) - start AS low, least(start + size, (j + 1) * block) - start AS high, (j * {STEP} + turn) % blocks < extra AS chosen)),
            x -> x.chosen) AS cuts""",
    )
    words = rf"split(regexp_replace(row.`{text_col}`, '^[\\x20\\x09-\\x0D]+', ''), '(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])')"
    part = rf"array_join(flatten(transform(cuts, x -> slice(words, CAST(x.low + 1 AS INT), CAST(x.high - x.low AS INT)))), '')"
    rows = rows.selectExpr("row", "explode(concat(array_repeat(cast(null as array<struct<low:bigint,high:bigint,chosen:boolean>>), cast(whole as int)), CASE WHEN size(cuts) > 0 THEN array(cuts) ELSE array() END)) AS cuts")
    rows = rows.selectExpr("row", "cuts", f"CASE WHEN cuts IS NOT NULL THEN {words} END AS words").selectExpr("row", f"CASE WHEN cuts IS NULL THEN row.`{text_col}` ELSE {part} END AS part")
    cols = []
    for c in df.columns:
        x = F.col("row").getField(c)
        cols.append((F.col("part") if c == text_col else F.length("part").cast(df.schema[c].dataType) if c == length_col else x).alias(c))
    return rows.select(*cols)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all ``documents`` to 150 % of their words."""
    return mix(table(spark, sf_dir, "documents")).drop("source")


OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
w AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows,
         [{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INT)] AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, CAST({MOST} * source_size AS DOUBLE) AS cap, CAST({MOST} * source_size AS DOUBLE) / weight AS level,
         CAST({SHARE} AS DOUBLE) * sum(source_size) OVER () AS budget FROM w),
g AS (
  SELECT *, sum(cap) OVER (ORDER BY level, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)
         + level * coalesce(sum(weight) OVER (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) <= budget AS is_full FROM r),
l AS (SELECT *, (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER () AS water FROM g),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * water END AS target,
         least({MAX_SHARDS}, (n_rows + {SHARD_ROWS - 1}) // {SHARD_ROWS}) AS shards FROM l),
b AS (
  SELECT *, CAST(greatest(1, least({BLOCK_TOKENS}, sum(source_size) OVER () // (256 * sum(shards) OVER ()))) AS BIGINT) AS block, sum(target) OVER () AS all_target FROM t),
n AS (SELECT *, CAST(floor(all_target / block + 0.5) AS BIGINT) AS n, count(*) FILTER (target > 0) OVER () AS many FROM b),
qs AS (
  SELECT *, CASE WHEN n >= 2 * many THEN least(n, CAST(ceil(target / all_target * many) + 1 AS BIGINT)) ELSE n END AS reach, target * n / all_target AS q FROM n WHERE target > 0),
ls AS (SELECT *, greatest(0, CAST(floor(q) AS BIGINT) - reach) AS low, least(n, CAST(ceil(q) AS BIGINT) + reach) AS high FROM qs),
ks AS (SELECT *, unnest(range(low, high)) AS k, FROM (SELECT *, n - sum(low) OVER () AS open FROM ls)),
ws AS (
  SELECT source, count(*) AS more FROM (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source ASC NULLS LAST, k) AS place FROM ks)
  WHERE place <= open GROUP BY source),
s AS (
  SELECT n.source, n.source_size, n.target, n.shards, n.block, CAST(coalesce(ls.low + coalesce(ws.more, 0), 0) AS BIGINT) AS quota
  FROM n LEFT JOIN ls ON n.source IS NOT DISTINCT FROM ls.source LEFT JOIN ws ON n.source IS NOT DISTINCT FROM ws.source),
p AS (
  SELECT d.*, s.block, s.source_size, s.target, s.quota, CAST('0x' || substr(d.key, 1, 8) AS BIGINT) % s.shards AS shard
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
h AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, min(quota) AS n, min(block) AS block FROM p GROUP BY source, shard),
hq AS (
  SELECT *, share / total AS part, CASE WHEN n >= 2 * many THEN least(n, CAST(ceil(share / total * many) + 1 AS BIGINT)) ELSE n END AS reach, share * n / total AS q
  FROM (SELECT *, CAST(shard_size AS DOUBLE) AS share, sum(CAST(shard_size AS DOUBLE)) OVER (PARTITION BY source) AS total, count(*) FILTER (shard_size > 0) OVER (PARTITION BY source) AS many FROM h)
  WHERE shard_size > 0),
hl AS (SELECT *, greatest(0, CAST(floor(q) AS BIGINT) - reach) AS low, least(n, CAST(ceil(q) AS BIGINT) + reach) AS high FROM hq),
hk AS (SELECT *, unnest(range(low, high)) AS k FROM (SELECT *, n - sum(low) OVER (PARTITION BY source) AS open FROM hl)),
hw AS (
  SELECT source, shard, count(*) AS more FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY share / (2 * k + 1) DESC, shard, k) AS place FROM hk)
  WHERE place <= open GROUP BY source, shard),
e AS (
  SELECT hl.source, hl.shard, hl.block, hl.shard_size, CAST((hl.low + coalesce(hw.more, 0)) * hl.block AS BIGINT) AS want, (hl.shard_size + hl.block - 1) // hl.block AS blocks
  FROM hl LEFT JOIN hw ON hl.source IS NOT DISTINCT FROM hw.source AND hl.shard = hw.shard),
f AS (SELECT *, least({MOST}, want // shard_size) AS whole FROM e),
o AS (
  SELECT source, shard, whole, blocks, CASE WHEN whole < {MOST} THEN least(blocks, CAST(floor((want - whole * shard_size) / block + 0.5) AS BIGINT)) ELSE 0 END AS extra,
         CAST('0x' || substr(md5('{SEED}|' || coalesce(source, '') || '|' || shard), 1, 8) AS BIGINT) % blocks AS turn FROM f),
z AS (
  SELECT p.*, o.whole, o.blocks, o.extra, o.turn, CAST(sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
  FROM p LEFT JOIN o ON p.source IS NOT DISTINCT FROM o.source AND p.shard = o.shard)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(whole * size + CASE WHEN size = 0 THEN 0 ELSE list_sum(list_transform(range(start // block, (start + size - 1) // block + 1), lambda j:
         CASE WHEN (j * {STEP} + turn) % blocks < extra THEN least(start + size, (j + 1) * block) - greatest(start, j * block) ELSE 0 END)) END, 0) AS BIGINT) AS taken
FROM z
"""
