"""Sharding (2): a uniform shuffle into shards of exact size by a communication matrix.

Rows are dealt to logical partitions by a hash of their content (not by
where they happen to lie, so a retried task deals the same).  How many rows
each partition sends to each shard is drawn from the multivariate
hypergeometric law with the partition sizes and the shard sizes as margins:
the law that a uniform permutation of all rows gives these counts.  The
matrix is drawn down a tree: a node with known counts per shard draws those
of its children one after another, each entry by inversion of the
hypergeometric distribution.  Then every partition permutes its rows (order of
a seeded hash), hands its counts to the shards, and every shard permutes what
it got (order of a second hash) to number its slots.

Only DataFrame and SQL functions are used.  No task holds a whole shard: the
second permutation is cut into ranges of the second hash, numbered from the
ranges' counts.

Odd input: a null text has size 8 and checksum 0; a null id is a value like
any other; equal rows are interchangeable, each gets a slot of its own; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.sources.io import stage

FAN_OUT = 32


def _uniform(*key: str) -> str:
    """A number in [0, 1) from a seeded hash of ``key``."""
    return f"(cast(shiftrightunsigned(xxhash64({', '.join(key)}), 11) as double) * pow(2D, -53))"


def _draw(pop: str, good: str, draws: str, u: str) -> str:
    """SQL for one hypergeometric draw: good ones among ``draws`` out of ``pop`` that hold ``good``.

    Inversion over the support, which is cut 12 standard deviations from the
    mode (beyond lies less than double precision can tell).  Weights relative
    to the mode follow from the ratio of neighbours, so no factorial of a
    large number is needed."""
    ratio = "({good} - {x}) * ({draws} - {x}) / (({x} + 1D) * ({pop} - {good} - {draws} + {x} + 1D))"
    up = ratio.format(pop="p.m", good="p.k", draws="p.n", x="(p.mode + i - 1D)")
    down = ratio.format(pop="p.m", good="p.k", draws="p.n", x="(p.mode - i)")
    walk = ratio.format(pop="p.m", good="p.k", draws="p.n", x="(p.a + i)")
    steps = "if({n} >= 1, sequence(1L, {n}), cast(array() as array<bigint>))"
    tail = "aggregate({seq}, struct(1D as w, 0D as s), (h, i) -> struct(h.w {op} ({r}) as w, h.s + h.w {op} ({r}) as s))"
    let = "element_at(transform(array({value}), {name} -> {body}), 1)"
    params = f"named_struct('m', cast({pop} as double), 'k', cast({good} as double), 'n', cast({draws} as double))"
    radius = ("cast(ceil(12D * sqrt(greatest(0D, q.n * (q.k / greatest(q.m, 1D)) * (1D - q.k / greatest(q.m, 1D)) "
              "* (q.m - q.n) / greatest(q.m - 1D, 1D)))) + 12D as bigint)")
    mode = "cast(floor((q.n + 1D) * (q.k + 1D) / (q.m + 2D)) as bigint)"
    low, high = "greatest(0L, cast(q.n - (q.m - q.k) as bigint))", "cast(least(q.k, q.n) as bigint)"
    window = (f"named_struct('m', q.m, 'k', q.k, 'n', q.n, 'mode', greatest({low}, least({high}, {mode})), "
              f"'a', greatest({low}, {mode} - {radius}), 'b', least({high}, {mode} + {radius}))")
    sums = (f"named_struct('up', {tail.format(seq=steps.format(n='(p.b - p.mode)'), op='*', r=up)}, "
            f"'down', {tail.format(seq=steps.format(n='(p.mode - p.a)'), op='/', r=down)})")
    # from the least outcome upwards: count the outcomes whose cumulated weight stays below u of the whole
    count = (f"aggregate({steps.format(n='(p.b - p.a)')}, struct(s.down.w as w, s.down.w as c, 0L as x), "
             f"(h, j) -> {let.format(value='j - 1L', name='i', body=f'struct(h.w * ({walk}) as w, h.c + h.w * ({walk}) as c, h.x + if(h.c <= {u} * (1D + s.up.s + s.down.s), 1L, 0L) as x)')}).x")
    body = let.format(value=sums, name="s", body=f"p.a + {count}")
    return let.format(value=params, name="q", body=let.format(value=window, name="p", body=body))


def _deal(rows: str, caps: str, pop: str, key: str) -> str:
    """SQL for one multivariate draw: how many of ``rows`` rows go to each shard with ``caps`` places left."""
    one = _draw("d.pop", "c", "d.n", _uniform(key, "size(d.got)"))
    step = (f"element_at(transform(array({one}), x -> struct(d.pop - c as pop, d.n - x as n, concat(d.got, array(x)) as got)), 1)")
    return (f"aggregate({caps}, struct(cast({pop} as bigint) as pop, cast({rows} as bigint) as n, cast(array() as array<bigint>) as got), "
            f"(d, c) -> {step}).got")


def communication_matrix(sizes: DataFrame, total: int, partitions: int, shards: int, seed: int) -> DataFrame:
    """(part, upto): for each non-empty partition the running counts of rows it hands to shards 0..shards-1.

    ``sizes``: (part, n).  Each level of the tree is one small group-by and
    one join; a row never holds more than FAN_OUT x shards numbers."""
    levels = 1
    while FAN_OUT**levels < partitions:
        levels += 1
    q, r = divmod(total, shards)
    caps = ", ".join(f"{q + (s < r)}L" for s in range(shards))
    spark = sizes.sparkSession
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.expr(f"array({caps})").alias("caps"))
    for level in range(levels):
        width = FAN_OUT ** (levels - level - 1)
        child = (F.col("part") / F.lit(width)).cast("long") if width > 1 else F.col("part")
        counts = (sizes.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
                  .groupBy((F.floor(F.col("child") / FAN_OUT)).alias("node"))
                  .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children")))      # at most FAN_OUT
        dealt = _deal("k.n", "t.caps", "aggregate(t.caps, 0L, (a, b) -> a + b)", f"{seed}, {level}, k.child")
        step = (f"element_at(transform(array({dealt}), got -> struct(zip_with(t.caps, got, (a, b) -> a - b) as caps, "
                "concat(t.out, array(struct(k.child as node, got as caps))) as out)), 1)")
        walk = (f"aggregate(children, struct(caps, cast(array() as array<struct<node: bigint, caps: array<bigint>>>) as out), "
                f"(t, k) -> {step}).out")
        nodes = nodes.join(counts, "node").select(F.explode(F.expr(walk)).alias("x")).select("x.node", "x.caps")
    running = "aggregate(caps, cast(array() as array<bigint>), (a, c) -> concat(a, array(c + coalesce(try_element_at(a, -1), 0L))))"
    return nodes.select(F.col("node").alias("part"), F.expr(running).alias("upto"))


def shuffle_to_shards(rows: DataFrame, columns: list[str], shards: int = 24, seed: int = 20260101,
                      rows_per_partition: int = 2000) -> DataFrame:
    """``columns`` of ``rows`` with ``shard`` (0..shards-1, sizes at most one apart) and ``slot`` (gapless in the shard).

    The columns should name all that tells rows apart; they are hashed.
    ``rows_per_partition`` sets how many logical partitions there are; at
    100 TB take some 100,000."""
    rows = stage(rows.select(*columns))              # the input is read once; the columns should be slim
    total = rows.count()
    parts = max(1, -(-total // rows_per_partition))
    blocks = max(1, -(-total // (shards * rows_per_partition)))
    keyed = rows.withColumn("_h1", F.xxhash64(F.lit(seed), *columns)).withColumn("_h2", F.xxhash64(F.lit(seed + 1), *columns)) \
        .withColumn("_part", F.pmod(F.xxhash64(F.lit(seed + 2), *columns), F.lit(parts)))
    sizes = keyed.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("n"))
    matrix = communication_matrix(sizes, total, parts, shards, seed).withColumnRenamed("part", "_part")
    local = Window.partitionBy("_part").orderBy("_h1", *columns)
    sent = (keyed.withColumn("_rank", F.row_number().over(local).cast("long")).join(matrix, "_part")
            .withColumn("shard", F.expr("size(filter(upto, c -> c < _rank))")).drop("upto", "_rank", "_part", "_h1"))
    # the shard's own permutation: by the second hash, in ranges of it
    sent = sent.withColumn("_range", F.expr(f"cast(cast(shiftrightunsigned(_h2, 11) as double) * pow(2D, -53) * {blocks} as int)"))
    before = (sent.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_range")) - F.col("_n")).drop("_n"))
    inside = Window.partitionBy("shard", "_range").orderBy("_h2", *columns)
    return (sent.withColumn("_row", F.row_number().over(inside)).join(before, ["shard", "_range"])
            .select(*columns, "shard", (F.col("_before") + F.col("_row") - 1).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str | Column = "text",
                    rows_per_partition: int = 2000, seed: int = 20260101) -> DataFrame:
    """Documents into shards by the law ``rows``: counts per shard at most one apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
                    F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    out = shuffle_to_shards(d, ["doc_id", "size", "text_crc32", "text_hash"], shards, seed, rows_per_partition)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
