"""Merkle manifest of a dataset: a content-addressed DAG of digests, and membership proofs by descent.

*Leaves.* A row's leaf is the digest of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
*Trees.* Within a group (a source) leaves ascend by id; every ``FAN`` consecutive nodes become the digest of their
concatenated digests, until one is left, the group's subroot.  The subroots, ordered by group, are the leaves of one
more tree, whose root stands for the dataset.  A digest is a lowercase hex SHA-256; what is hashed above the leaves is
the children's digests as hex text.

*DAG.* ``nodes`` holds a record of digest and children for each distinct inner digest, whichever tree it is from.
*Descent.* A request names a leaf by the rank of its group and its rank in the group; the base-``FAN`` digits of the
two lead from the root to it.  Requests that share digits walk together: a step holds one row for each distinct prefix
of them, joins its digest with the records, keeps the children that a request asks for and collects the others as the
left and right part of that step.  So a level has no more rows than the tree has nodes, no key is met by all requests,
and the steps' parts, reversed, are the proof of all leaves of a run.

Ranks come from a range partitioning (``dense_row_id``) less the rows of smaller groups, so a group that holds a third of
all rows is spread over the partitions; no group is collected, runs hold at most ``FAN`` entries.

Cases: nulls in any column are ``-``; a null group is a group of its own and comes first, null ids come first in their
group; rows with equal ids are ordered by their leaves, and equal rows are leaves of their own with equal digests; an
empty table has an empty manifest; further columns don't count, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import release, staged
from merchant_signals.operators.row_ids import dense_row_id

#: Children of a node: a base-16 digit a level.
BITS = 4
FAN = 1 << BITS

#: Groups whose ranks are broadcast (some 30 MB); more are joined, hot ones split by adaptive execution.
MAX_GROUPS = 200_000

#: The leaf's fields, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _ranked(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """leaves (grp, id, leaf, ...) -> with s (rank of the group), r (rank in it), both from 0, and n (the group's leaves);
    and the tables that it reads."""
    order = leaves.withColumn("_some", F.col("grp").isNotNull()).withColumn("_g", F.coalesce("grp", F.lit("")))
    sorted_ = staged(dense_row_id(order, ["_some", "_g", "id", "leaf"], "_row", start=0), "manifest-rows")
    groups = sorted_.groupBy("_some", "_g").agg(F.min("_row").alias("_start"), F.count(F.lit(1)).alias("n"))
    groups = staged(dense_row_id(groups, ["_some", "_g"], "s", start=0), "manifest-groups")
    few = groups.limit(MAX_GROUPS + 1).count() <= MAX_GROUPS
    out = sorted_.join(F.broadcast(groups) if few else groups, ["_some", "_g"]).withColumn("r", F.col("_row") - F.col("_start"))
    return out.drop("_some", "_g", "_start", "_row"), [sorted_, groups]


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return sum([(n > F.lit(FAN ** k)).cast("int") for k in range(1, 63 // BITS)], (n > 1).cast("int"))


def _tree(level: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """level (s, r, n, digest): the leaves of many trees, n of them in a tree -> s, digest of their tops; the written levels."""
    tops, levels = [], []
    while True:
        tops.append(level.where(F.col("n") == 1).select("s", "digest"))
        more = level.where(F.col("n") > 1)
        if not more.limit(1).count():
            break
        runs = more.groupBy("s", F.shiftright("r", BITS).alias("r")).agg(
            F.ceil(F.max("n") / FAN).alias("n"),
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("r").alias("at"), "digest"))), lambda x: x["digest"]).alias("children"))
        level = staged(runs.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), f"{name}-level")
        levels.append(level)
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out, levels


class Manifest:
    """The DAG of a table: ``leaves`` (s, r, n, leaf and the rows' columns), ``nodes`` (digest, children), the root, and the number of
    groups."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame, root: str | None, groups: int) -> None:
        self.leaves, self.nodes, self.root, self.groups = leaves, nodes, root, groups

    def descend(self, requests: DataFrame) -> DataFrame:
        """requests (s, run, n: the group's leaves): runs of leaves asked for -> s, run, subroot, digest, children (the run's
        digests, null for a group of one leaf), path (structs of left and right from the run's parent up to the root)."""
        spark = requests.sparkSession
        none = F.array().cast("array<struct<left:string,right:string>>")
        asked = staged(requests.distinct().withColumn("height", _height(F.col("n"))), "manifest-requests")
        # over the groups: a row for each prefix of the digits of s that is asked for
        at = spark.createDataFrame([(0, self.root)], "prefix bigint, digest string").withColumn("path", none)
        up = 0
        while FAN ** up < self.groups:
            up += 1
        for step in range(up - 1, -1, -1):
            at = self._step(at, asked.select(F.shiftright("s", BITS * step).alias("prefix")).distinct(), [])
        at = at.select(F.col("prefix").alias("s"), F.lit(0).cast("long").alias("prefix"), F.col("digest").alias("subroot"), "digest", "path")
        # inside the groups: a row for each group and prefix of the digits of the run; runs are one step above leaves
        todo = staged(at.join(asked.select("s", "height").distinct(), "s"), "manifest-step")
        parts = [todo.where(F.col("height") <= 1)]
        for step in range((todo.agg(F.max("height").alias("h")).first()["h"] or 0) - 2, -1, -1):
            deep = F.col("height") >= step + 2  # a tree takes part from its own height on
            want = asked.where(deep).select("s", F.shiftright("run", BITS * step).alias("prefix")).distinct()
            moved = staged(self._step(todo.where(deep), want, ["s", "height", "subroot"]), "manifest-step")
            if step == 0:
                parts.append(moved)
            else:
                todo = moved.unionByName(todo.where((F.col("height") < step + 2) & (F.col("height") >= 2)))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        records = self.nodes.select(F.col("digest").alias("_d"), "children")
        runs = out.where(F.col("height") > 0).join(records, F.col("digest") == F.col("_d")).drop("_d")
        alone = out.where(F.col("height") == 0).withColumn("children", F.lit(None).cast("array<string>"))
        return runs.unionByName(alone).select("s", F.col("prefix").alias("run"), "subroot", "digest", "children", "path")

    def _step(self, at: DataFrame, want: DataFrame, keys: list[str]) -> DataFrame:
        """One digit further down: the children asked for, each with the others as left and right of a new path entry."""
        opened = at.join(self.nodes, "digest").select(
            *keys, (F.col("prefix") * FAN).alias("_first"), "path", "children", F.posexplode("children").alias("_digit", "_child"))
        on = [k for k in keys if k == "s"]
        opened = opened.withColumn("prefix", F.col("_first") + F.col("_digit")).join(want, [*on, "prefix"], "left_semi")
        return opened.select(*keys, "prefix", F.col("_child").alias("digest"),
                             F.concat(F.array(_others(F.col("_digit"))), "path").alias("path"))


def _others(digit: Column) -> Column:
    """The children before and after one of them."""
    return F.struct(F.array_join(F.slice("children", F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice("children", digit + 2, F.lit(FAN)), "").alias("right"))


def build(rows: DataFrame, keep: list[str]) -> Manifest:
    """rows (grp, id, leaf and the columns ``keep``) -> manifest."""
    spark = rows.sparkSession
    ranked, read = _ranked(rows.select("grp", "id", "leaf", *[c for c in keep if c not in ("grp", "id", "leaf")]))
    leaves = staged(ranked, "manifest-leaves")
    release(*read)
    tops, levels = _tree(leaves.select("s", "r", "n", F.col("leaf").alias("digest")), "manifest")
    tops = staged(tops, "manifest-tops")
    groups = tops.count()
    over, upper = _tree(tops.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("r"), F.lit(groups).cast("long").alias("n"), "digest"), "manifest-over")
    top = over.first()  # one row, or none
    nodes = spark.createDataFrame([], "digest string, children array<string>")
    for level in [*levels, *upper]:
        nodes = nodes.unionByName(level.select("digest", "children"))
    nodes = staged(nodes.dropDuplicates(["digest"]), "manifest-nodes")
    release(*levels, *upper, tops)
    return Manifest(leaves, nodes, top["digest"] if top else None, groups)


def proofs(manifest: Manifest, keep: list[str], alternative: str) -> DataFrame:
    """Every leaf's way to the root: ``keep``, leaf, subroot, root, proof (the siblings' digests from the run up to the
    root, joined) and folded (the root computed from ``alternative``, or the leaf where that is null, and the proof)."""
    cols = [*dict.fromkeys([*keep, "leaf", alternative])]
    run = F.shiftright("r", BITS).alias("run")
    runs = manifest.leaves.groupBy("s", run).agg(F.array_sort(F.collect_list(F.struct("r", *cols))).alias("entries"))
    found = manifest.descend(manifest.leaves.where(F.col("r").bitwiseAND(FAN - 1) == 0).select("s", run, "n"))
    whole = runs.join(found, ["s", "run"]).select("subroot", "children", "path", F.explode("entries").alias("e"))
    own = _others(F.col("e.r").bitwiseAND(FAN - 1).cast("int"))
    # a group of one leaf has no run: its leaf is the subroot, and nothing is hashed below that
    steps = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat(F.array(own), F.col("path")))
    start = F.coalesce(F.col(f"e.{alternative}"), F.col("e.leaf"))
    return whole.withColumn("steps", steps).select(
        *[F.col(f"e.{c}").alias(c) for c in keep], F.col("e.leaf").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"),
        F.array_join(F.transform("steps", lambda x: F.concat(x["left"], x["right"])), "").alias("proof"),
        F.aggregate("steps", start, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256)).alias("folded"))


def tampered_text(text: Column) -> Column:
    """A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded of all documents, with a fifth of the texts tampered with after the
    manifest was made (5 divides the CRC-32 of the decimal id; rows without an id stay as they are)."""
    d = docs.select(*[F.col(c) for c in FIELDS])
    changed = [tampered_text(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = d.select(F.col("source").cast("string").alias("grp"), F.col("doc_id").alias("id"), leaf_digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
                    F.when(hit, leaf_digest(*changed)).alias("tampered"))
    return proofs(build(rows, ["tampered"]), ["id"], "tampered").withColumnRenamed("id", "doc_id")
