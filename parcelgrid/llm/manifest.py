"""Merkle manifest of a dataset by nested-interval labels.

Each row is a leaf: the SHA-256 of its fields. The leaves of a group ascend by
id; runs of three neighbours become their parent, until one node is left, the
group's subroot. The subroots, ordered by group, become the root in the same way.

Every node carries the interval of leaf ranks that it covers. Levels are
bucketed in bands of ``BAND``: a band's bucket is the interval of one node at
its top, and holds at most ``FAN ** BAND`` nodes at its bottom, so a bucket is one
bounded row whatever the size of a group. Bands are built upwards, each 729
times smaller than the one below. Then, from the top, a containment join
attaches to each bucket the proof of the ancestor whose interval covers it;
inside the bucket the siblings on each level are what the difference between a
parent's interval and the child's leaves. Only the narrow leaves are shuffled,
and a proof, which all leaves of a bucket share from there on, travels once per
bucket.

Ranks come from a range sort: rows are numbered within a task and shifted by
the counts of the tasks before, so no group is ever in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parcelgrid.llm.scratch import Kept

FAN = 3
BAND = 6
WIDTH = FAN**BAND
#: The counts of tasks, of some 100 bytes each, are broadcast up to so many; beyond, they are joined by shuffle.
BROADCAST_RUNS = 100_000
#: A group: whether it has a name (those without come first), and the name.
TREE = ["named", "name"]
#: One level of a proof: the digests of the siblings before and after, joined.
STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` within their ``TREE`` by ``order``, which has no ties, and ``n``, the size of the tree."""
    by = [F.col(c).asc_nulls_first() for c in (*TREE, *order)]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = Kept(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "sorted").df
    task = F.shiftright("at", 33).alias("task")
    runs = placed.groupBy(task, *TREE).agg(F.min("at").alias("first"), F.count("*").alias("held"))
    before = Window.partitionBy(*TREE).orderBy("task")
    runs = runs.select(
        "task",
        *TREE,
        (F.sum("held").over(before) - F.col("held") - F.col("first")).alias("shift"),
        F.sum("held").over(Window.partitionBy(*TREE)).alias("n"),
    )
    runs = Kept(runs, "runs").df
    side = F.broadcast(runs) if runs.limit(BROADCAST_RUNS + 1).count() <= BROADCAST_RUNS else runs
    met = placed.withColumn("task", task).join(side, ["task", *TREE])
    return met.withColumn("rank", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def parents(nodes: Column) -> Column:
    """The level above an array of ``lo, hi, h`` nodes."""
    size = F.size(nodes)

    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * FAN + 1, FAN)
        return F.struct(
            F.get(nodes, i * FAN)["lo"].alias("lo"),
            F.get(nodes, F.least(i * FAN + FAN, size) - 1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(run, lambda x: x["h"]), ""), 256).alias("h"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((size - 1) / FAN).cast("int")), parent)


@dataclass
class Tree:
    """Bands of buckets, the lowest first, and ``TREE, h``: the one node left of each tree."""

    bands: list[DataFrame]
    roots: DataFrame


def grown(nodes: DataFrame, carried: list[str]) -> Tree:
    """The trees over ``TREE, rank, n, h`` nodes; the lowest buckets also hold the ``carried`` columns."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    level = nodes.select(*TREE, "n", F.col("rank").alias("pos"), "h", F.struct(*carried).alias("of"))
    level = level.withColumns({"lo": F.col("pos"), "hi": F.col("pos") + 1})
    bands = []
    while True:
        bucket = F.floor(F.col("pos") / WIDTH).alias("bucket")
        held = F.sort_array(F.collect_list(F.struct("pos", "lo", "hi", "h", "of")))
        rows = level.groupBy(*TREE, "n", bucket).agg(held.alias("held"))
        # levels until one node is left, but no more than the band has
        levels = sum((F.col("n") > FAN**k).cast("int") for k in range(BAND))
        rows = rows.withColumn("levels", levels)
        rows = rows.withColumn("n0", F.transform("held", lambda x: F.struct(x["lo"], x["hi"], x["h"])))
        for k in range(BAND):
            up = F.when(F.col("levels") > k, parents(F.col(f"n{k}"))).otherwise(F.col(f"n{k}"))
            rows = rows.withColumn(f"n{k + 1}", up)
        rows = rows.withColumn("top", F.get(f"n{BAND}", F.lit(0))).drop(f"n{BAND}")
        bands.append(Kept(rows, "band").df)
        top = bands[-1].select(*TREE, "n", "bucket", "top.*")
        if largest <= WIDTH:
            return Tree(bands, top.select(*TREE, "h"))
        largest = -(-largest // WIDTH)
        level = top.select(
            *TREE, F.ceil(F.col("n") / WIDTH).alias("n"), F.col("bucket").alias("pos"), "h", F.lit(None).alias("of"), "lo", "hi"
        )


def siblings(level: int, index: Column, lo: Column, hi: Column) -> Column:
    """The nodes of a level in the interval of the parent, but not in that of the child: before it and after it."""
    run = F.slice(f"n{level}", F.floor(index / FAN ** (level + 1)).cast("int") * FAN + 1, FAN)
    joined = lambda nodes: F.array_join(F.transform(nodes, lambda x: x["h"]), "")
    return F.struct(
        joined(F.filter(run, lambda x: x["hi"] <= lo)).alias("left"),
        joined(F.filter(run, lambda x: x["lo"] >= hi)).alias("right"),
    )


def proven(tree: Tree, above: DataFrame, attached: list[str]) -> DataFrame:
    """``TREE``, the carried columns, ``h``, ``proof`` and the ``attached`` ones of every node at the bottom.

    ``above`` has ``TREE, proof`` and the ``attached`` columns, one row per tree: the
    proof of the tree's own root.
    """
    covering = above.select(*(F.col(c).alias(f"of_{c}") for c in (*TREE, "proof", *attached)))
    met = [F.col(c) == F.col(f"of_{c}") for c in TREE]
    for band in reversed(tree.bands):
        buckets = band.join(covering, met)
        if band is not tree.bands[-1]:
            buckets = buckets.filter("of_lo <= top.lo AND top.hi <= of_hi")

        def step(k: int, i: Column, x: Column) -> Column:
            return F.when(F.col("levels") > k, siblings(k, i, x["lo"], x["hi"]))

        def labelled(x: Column, i: Column) -> Column:
            own = F.filter(F.array(*(step(k, i, x) for k in range(BAND))), lambda s: s.isNotNull())
            return F.struct(
                x["pos"].alias("pos"), x["lo"].alias("lo"), x["hi"].alias("hi"), x["h"].alias("h"), x["of"].alias("of"),
                F.concat(own, F.col("of_proof")).alias("proof"),
            )

        each = buckets.select(*TREE, *(f"of_{c}" for c in attached), F.explode(F.transform("held", labelled)).alias("x"))
        nodes = each.select(*TREE, *(F.col(f"of_{c}").alias(c) for c in attached), "x.*")
        covering = nodes.select(*(F.col(c).alias(f"of_{c}") for c in (*TREE, "pos", "lo", "hi", "proof", *attached)))
        # the bucket of a band is one node of the band above
        met = [*(F.col(c) == F.col(f"of_{c}") for c in TREE), F.col("bucket") == F.col("of_pos")]
    return nodes.select(*TREE, "of.*", "h", "proof", *attached)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``id, leaf, subroot, root, proof`` and the ``carry`` columns, one row per row of ``docs``.

    ``proof`` lists the siblings of the leaf's ancestors from the leaf to the
    root, an array of ``left, right``: :func:`folded` gives the root again. Null
    fields differ from empty ones. A null group is a group of its own, the first;
    null ids come first; rows of equal id ascend by their leaf, and repeated rows
    are leaves of their own. An empty table gives no rows, other columns do not
    count. A dataset of one row has an empty proof, and its leaf is the root.
    """
    name = docs[group_col].cast("string")
    extra = {f"x{i}": value for i, value in enumerate((carry or {}).values())}
    rows = docs.select(
        name.isNotNull().alias("named"),
        F.coalesce(name, F.lit("")).alias("name"),
        docs[id_col].alias("id"),
        leaf(*(docs[c] for c in fields)).alias("h"),
        *(value.alias(key) for key, value in extra.items()),
    )
    # rows alike in everything are told apart, so that they can be dealt over several tasks
    rows = Kept(rows.withColumn("seen", F.monotonically_increasing_id()), "leaves").df
    leaves = grown(ranked(rows, ["id", "h", "seen"]), ["id", *extra])
    subroots = leaves.roots.select(
        F.lit(True).alias("named"), F.lit("").alias("name"), F.struct(*TREE).alias("group"), "h"
    )
    whole = grown(ranked(subroots, ["group"]), ["group"])
    root = whole.roots.select(*TREE, F.array().cast(T.ArrayType(STEP)).alias("proof"), F.col("h").alias("root"))
    tops = proven(whole, root, ["root"])
    tops = tops.select("group.*", F.col("h").alias("subroot"), "root", "proof")
    found = proven(leaves, Kept(tops, "subroots").df, ["subroot", "root"])
    return found.select(
        F.col("id").alias(id_col),
        F.col("h").alias("leaf"),
        "subroot",
        "root",
        "proof",
        *(F.col(key).alias(c) for key, c in zip(extra, carry or {})),
    )


def tamper_check(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "source",
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per row of ``docs``.

    Where 2 divides the CRC-32 of the id as text, the line breaks of the text are
    deleted before the leaf is computed anew. The new leaf and the old siblings
    are folded; what does not give the root is not verified. A null id is not
    tampered with. The rest is as in :func:`manifest`.
    """
    chosen = F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 2 == 0, F.lit(False))
    broken = F.replace(docs[text_col].cast("string"), F.lit("\n"), F.lit(""))
    cut = chosen & docs[text_col].cast("string").contains("\n")
    again = F.when(cut, leaf(*(broken if c == text_col else docs[c] for c in fields)))
    known = manifest(docs, fields, id_col, group_col, {"again": again})
    root = folded(F.coalesce("again", "leaf"), F.col("proof")).alias("folded_root")
    checked = known.select(id_col, "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), root)
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
