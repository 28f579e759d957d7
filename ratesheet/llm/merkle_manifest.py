"""Merkle manifest of a dataset: every row a leaf, a tree for each source, one root over all.

A leaf is the sha256 (lowercase hex) of a row's fields. The leaves of a source stand in the order
of ``doc_id``; every three neighbours become the hash of their digests until one is left. The roots
of the sources, in the order of their names, form the tree above them.

No row is sorted to find its place. Ids become bitmaps of 512 bits for each (source, block of ids),
merged by ``bit_or`` before and after the shuffle; only blocks that hold an id are kept. Counts of
set bits, summed over four levels of 2 ** 14 entries, form the directory; a leaf meets the bitmap of
its block and its place is the directory's entry plus the bits below its own. Places then key slot
arrays of 3 ** 7 leaves, each of which reduces seven levels at once; the heads of these arrays are
the slots of the next ones. No task holds more than an array, a block or a directory page.

Rules: null and empty values differ in the leaf. A null source is a source of its own, ordered first;
a null ``doc_id`` comes before all others of its source. Rows that share source and ``doc_id`` stand
in the order of their leaves, and equal rows are as many leaves. A very long text is hashed in
the task that reads it. An empty table has no rows. Columns beyond the five named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesheet.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ids of a bitmap as a power of two, and entries of a directory page as one.
BLOCK_BITS, PAGE_BITS, LEVELS = 9, 14, 4
WORDS = 1 << (BLOCK_BITS - 6)
#: Neighbours that become one node; levels that one slot array reduces.
FANOUT, RUN_LEVELS = 3, 7
RUN = FANOUT**RUN_LEVELS
_BEFORE = (Window.unboundedPreceding, -1)


def _sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    )


def leaf(**changed: Column) -> Column:
    """Digest of a row, with other values for the fields named."""
    return _sha(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]))


def without_newlines() -> Column:
    """The leaf after a text has lost its line ends; null where nothing changes.

    Rows with an odd crc32 of the doc_id, and those without one, are left alone.
    """
    changes = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 2 = 0 and instr(text, '\\n') > 0")
    return F.when(changes, leaf(text=F.translate("text", "\n", "")))


def _source() -> Column:
    """Names in UTF-8 order, null before all of them."""
    return F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit(":"), F.col("source")))


def _block() -> Column:
    return F.coalesce(F.shiftright("doc_id", BLOCK_BITS), F.lit(-(1 << 63)))


def _in_block() -> Column:
    """0 to 511, for negative ids as well."""
    return F.coalesce(F.pmod("doc_id", F.lit(1 << BLOCK_BITS)), F.lit(0)).cast("int")


def bitmaps(docs: DataFrame) -> DataFrame:
    """(tree, block, n, ones, w0 .. w7): rows, distinct ids and the bitmap of each block of ids."""
    bit = F.expr("shiftleft(1L, at & 63)")
    words = [F.bit_or(F.when(F.shiftright("at", 6) == w, bit)) for w in range(WORDS)]
    merged = (
        docs.select(_source().alias("tree"), _block().alias("block"), _in_block().alias("at"))
        .groupBy("tree", "block")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.coalesce(word, F.lit(0)).alias(f"w{w}") for w, word in enumerate(words)],
        )
    )
    return merged.withColumn("ones", sum(F.bit_count(f"w{w}") for w in range(WORDS)))


def directory(blocks: DataFrame) -> DataFrame:
    """(tree, block, base, total): rows of the tree before the block, and in all."""
    levels = [blocks.select("tree", F.col("block").alias("at"), "n")]
    for _ in range(LEVELS - 1):
        page = F.shiftright("at", PAGE_BITS).alias("at")
        levels.append(levels[-1].groupBy("tree", page).agg(F.sum("n").alias("n")))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("at").rowsBetween(*_BEFORE)), F.lit(0))
    found = levels[-1].select("tree", "at", before.alias("base"), F.sum("n").over(tree).alias("total"))
    inside = Window.partitionBy("tree", "page").orderBy("at").rowsBetween(*_BEFORE)
    for level in reversed(levels[:-1]):
        pages = found.select("tree", F.col("at").alias("page"), F.col("base").alias("below"), "total")
        paged = level.withColumn("page", F.shiftright("at", PAGE_BITS))
        counted = paged.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        found = counted.join(pages, ["tree", "page"]).select(
            "tree", "at", (F.col("below") + F.col("inside")).alias("base"), "total"
        )
    return found.withColumnRenamed("at", "block")


def _rank() -> Column:
    """Set bits of the block below the row's own."""
    below = F.expr("~shiftleft(-1L, at & 63)")
    word = F.shiftright("at", 6)
    ones = [
        F.when(word > w, F.bit_count(f"w{w}"))
        .when(word == w, F.bit_count(F.col(f"w{w}").bitwiseAND(below)))
        .otherwise(0)
        for w in range(WORDS)
    ]
    return sum(ones[1:], ones[0])


def _among_repeated(rows: DataFrame) -> DataFrame:
    """Slots of rows in blocks where an id occurs twice: by id, then by leaf, copies in a row.

    Equal rows are counted first. Sums over the ids of a block, over 4,096 prefixes of the leaf,
    and over the leaves of a prefix give the place, so that no window holds a whole hot id.
    """
    same = rows.groupBy("tree", "total", "block", "base", "at", "doc_id", "node", "claim").agg(
        F.count(F.lit(1)).alias("n")
    )
    same = same.withColumn("prefix", F.substring("node", 1, 3))

    def before(df: DataFrame, inside: list[str], key: str, name: str) -> DataFrame:
        window = Window.partitionBy(*inside).orderBy(key).rowsBetween(*_BEFORE)
        sums = df.groupBy(*inside, key).agg(F.sum("n").alias("n"))
        return sums.select(*inside, key, F.coalesce(F.sum("n").over(window), F.lit(0)).alias(name))

    ids = before(same, ["tree", "block"], "at", "x")
    prefixes = before(same, ["tree", "block", "at"], "prefix", "y")
    leaves = before(same, ["tree", "block", "at", "prefix"], "node", "z")
    first = F.expr("base + x + y + z")
    return (
        same.join(ids, ["tree", "block", "at"])
        .join(prefixes, ["tree", "block", "at", "prefix"])
        .join(leaves, ["tree", "block", "at", "prefix", "node"])
        .select(
            "tree", "total", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), "node",
            F.struct("doc_id", "claim").alias("own"),
        )
    )


def placed(docs: DataFrame, claim: Column) -> tuple[DataFrame, int]:
    """Leaves with their slot, (tree, total, slot, node, own), and the leaves of the largest tree."""
    blocks = written(bitmaps(docs), "bitmaps")
    crowded = blocks.withColumn("crowded", F.col("n") > F.col("ones")).drop("n", "ones")
    found = written(crowded.join(directory(blocks), ["tree", "block"]), "directory")
    rows = docs.select(
        _source().alias("tree"), _block().alias("block"), _in_block().alias("at"), "doc_id",
        leaf().alias("node"), claim.alias("claim"),
    ).join(found, ["tree", "block"])
    known = written(
        rows.select("tree", "total", "block", "base", "at", "doc_id", "node", "claim", "crowded", _rank().alias("rank")),
        "leaves",
    )
    single = known.where("not crowded").select(
        "tree", "total", F.expr("base + rank").alias("slot"), "node", F.struct("doc_id", "claim").alias("own")
    )
    largest = found.agg(F.max("total")).first()[0] or 0
    return single.unionByName(_among_repeated(known.where("crowded"))), largest


def _joined(level: str) -> Column:
    """The level above: a digest for every three neighbours."""
    runs = F.sequence(F.lit(0), F.expr(f"int((size({level}) - 1) div {FANOUT})"))
    return F.transform(runs, lambda r: _sha(F.array_join(F.slice(level, r * FANOUT + 1, FANOUT), "")))


def _packed(nodes: DataFrame) -> DataFrame:
    """Slot arrays: the nodes of each run in order (l0) and the levels above them (l1 .. l7)."""
    packed = (
        nodes.groupBy("tree", "total", F.expr(f"slot div {RUN}").alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("slot", "node", "own"))).alias("slots"))
        .withColumn("l0", F.transform("slots", lambda x: x["node"]))
    )
    for k in range(RUN_LEVELS):
        level = F.when(F.col("total") > FANOUT**k, _joined(f"l{k}")).otherwise(F.col(f"l{k}"))
        packed = packed.withColumn(f"l{k + 1}", level)
    own = F.transform("slots", lambda x: x["own"])
    levels = [f"l{k}" for k in range(RUN_LEVELS + 1)]
    return written(packed.select("tree", "total", "run", own.alias("owns"), *levels), "slots")


def _steps(at: Column) -> Column:
    """For each level of a run: the digests left and right of the node above leaf ``at``."""
    steps = []
    for k in range(RUN_LEVELS):
        node = F.floor(at / FANOUT**k).cast("int")
        start, own = node - node % FANOUT, node % FANOUT
        left = F.array_join(F.slice(f"l{k}", start + 1, own), "")
        right = F.array_join(F.slice(f"l{k}", node + 2, FANOUT - 1 - own), "")
        steps.append(F.when(F.col("total") > FANOUT**k, F.struct(left.alias("l"), right.alias("r"))))
    return F.filter(F.array(*steps), lambda step: step.isNotNull())


def _above(packed: DataFrame, largest: int) -> DataFrame:
    """(tree, run, path, root): the way from each slot array's head to the root of its tree."""
    total = F.expr(f"(total + {RUN - 1}) div {RUN}").alias("total")
    heads = packed.select(
        "tree", total, F.col("run").alias("slot"), F.col(f"l{RUN_LEVELS}")[0].alias("node"), F.lit(0).alias("own")
    )
    if largest <= RUN:
        none = F.expr("cast(array() as array<struct<l: string, r: string>>)")
        return heads.select("tree", F.col("slot").alias("run"), none.alias("path"), F.col("node").alias("root"))
    return climbed(heads, -(-largest // RUN)).withColumnRenamed("slot", "run").drop("own")


def climbed(nodes: DataFrame, largest: int) -> DataFrame:
    """(tree, slot, own, path, root) of nodes (tree, total, slot, node, own)."""
    packed = _packed(nodes)
    above = _above(packed, largest)
    way = F.transform(
        "owns", lambda own, at: F.struct(at.alias("at"), own.alias("own"), F.concat(_steps(at), F.col("path")).alias("path"))
    )
    return packed.join(above, ["tree", "run"]).select("tree", "run", "root", F.inline(way)).select(
        "tree", F.expr(f"run * {RUN} + at").alias("slot"), "own", "path", "root"
    )


def _in_order(subroots: DataFrame) -> tuple[DataFrame, int]:
    """Sources as nodes of one tree, numbered by name: ranges of names, then places in a range."""
    dealt = subroots.repartitionByRange("tree").sortWithinPartitions("tree")
    part, row = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")
    dealt = written(dealt.select("tree", "subroot", part, row), "subroots")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0))
    ranked = dealt.join(counts.select("part", base.alias("base")), "part")
    many = dealt.count()
    slot = F.expr("base + row - shiftleft(cast(part as bigint), 33)")
    return ranked.select(
        F.lit(0).alias("tree"), F.lit(many).cast("bigint").alias("total"), slot.alias("slot"),
        F.col("subroot").alias("node"), F.col("tree").alias("own"),
    ), many


def _whole(docs: DataFrame, claim: Column) -> DataFrame:
    """Slot arrays of all leaves with the way from each array's head to the root over all."""
    nodes, largest = placed(docs, claim)
    packed = _packed(nodes)
    above = written(_above(packed, largest).withColumnRenamed("root", "subroot"), "above")
    tops = climbed(*_in_order(above.select("tree", "subroot").distinct()))
    tops = tops.select(F.col("own").alias("tree"), F.col("path").alias("rest"), "root")
    led = above.join(tops, "tree").select(
        "tree", "run", F.concat("path", "rest").alias("path"), F.size("path").alias("depth"), "subroot", "root"
    )
    return packed.join(led, ["tree", "run"])


def _folded(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda acc, step: _sha(F.concat(step["l"], acc, step["r"])))


def _leaves(whole: DataFrame, finish) -> DataFrame:
    """One row a leaf: what ``finish`` makes of (own, leaf, path)."""
    leaves = F.transform(
        F.arrays_zip("owns", "l0"),
        lambda x, at: F.struct(
            x["owns"].alias("own"), x["l0"].alias("leaf"), at.alias("at"),
            F.concat(_steps(at), F.col("path")).alias("path"),
        ),
    )
    rows = whole.select("tree", "run", "subroot", "root", leaves.alias("leaves"))
    return rows.select("tree", "run", "subroot", "root", F.inline(F.transform("leaves", finish)))


def manifest(docs: DataFrame) -> DataFrame:
    """(source, slot, doc_id, leaf, subroot, root, proof) of every row.

    ``proof`` lists, level by level, the digests left (l) and right (r) of the node on the way to
    ``root``; folding ``leaf`` with them gives it.
    """
    found = _leaves(
        _whole(docs, F.lit(None).cast("string")),
        lambda x: F.struct(
            x["at"].alias("at"), x["own"]["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"), x["path"].alias("proof")
        ),
    )
    source = F.when(F.col("tree") != "-", F.expr("substring(tree, 2)"))
    slot = F.expr(f"run * {RUN} + at").alias("slot")
    return found.select(source.alias("source"), slot, "doc_id", "leaf", "subroot", "root", "proof")


def audited(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``claim`` gives the leaf that a row now has, null for its own. It is folded with the
    manifest's proof, and ``verified`` says whether that ends in the manifest's root.
    """
    found = _leaves(
        _whole(docs, without_newlines() if claim is None else claim),
        lambda x: F.struct(
            x["own"]["doc_id"].alias("doc_id"),
            x["leaf"].alias("leaf"),
            _sha(F.array_join(F.transform(x["path"], lambda s: F.concat(s["l"], s["r"])), "")).alias("proof_sha256"),
            _folded(F.coalesce(x["own"]["claim"], x["leaf"]), x["path"]).alias("folded_root"),
        ),
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
