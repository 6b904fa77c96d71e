"""A manifest of a dataset: a tree of hashes per group of documents, a tree over the groups, and a proof for every document.

* A document's *leaf* is the hash of its fields, each written as ``-`` if null, else as its byte count, a colon and its value.
* Within a group leaves ascend by id (ties by leaf). While a group has several nodes, every ``FAN`` consecutive ones (the last run may
  be shorter, even one node) become the hash of their digests. What remains is the group's *subroot*; subroots in the order of their groups,
  null first, then by bytes, become the *root* in the same way.
* A document's *path* has, for each level from its leaf to the root, the digests left and right of it in its run. Folding a leaf with its path gives the root.

Each level is one window over runs: columns of fixed offset, ``lag`` and ``lead`` by 1 to ``FAN - 1``, masked by a node's slot in its run and by the run's
length, hold its siblings, and the row of a run's first child hashes the parent. Windows hold ``FAN`` rows, so a group with a third of all documents is
spread like any other; places come from ranks by cells. A level above the leaves is a ``FAN``-th of the one below; levels are written to the shared folder.
Only the number of rows of a level and the one root reach the driver. Paths go down the tree by joins on the key of the window below, so leaves with
their siblings are not shuffled again.

Defined results: a null id comes before all others; rows equal in all fields are several leaves with equal digests and paths of their own; a group with one
document has its leaf as subroot; with one group its subroot is the root; an empty table has no rows and no root; fields other than those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.ordered import number_rows, range_cells
from .kit import materialize, read

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a cell when places are numbered.
CELL = 50_000


def written(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[written(c) for c in fields]), 256)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts like the group: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(nodes: DataFrame, keys: list[str], order: list[str], cell: int = CELL) -> DataFrame:
    """Nodes with their place ``pos``, from 0, among those of their key."""
    cells = range_cells(nodes, [F.col(c) for c in [*keys, *order]], rows=cell)
    numbered = number_rows(cells, keys, ["_l0", "_l1"], [F.col(c) for c in order], "pos")
    return numbered.withColumn("pos", F.col("pos") - 1).drop("_l0", "_l1")


def with_siblings(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """Nodes (``grp``, ``pos``, ``digest``) with their ``run``, what stands ``left`` and ``right`` of them there, and whether they are all that is left of their group."""
    slot = F.pmod("pos", F.lit(fan))
    w = W.partitionBy("grp", "run").orderBy("pos")
    left = [F.when(slot >= d, F.lag("digest", d).over(w)) for d in range(fan - 1, 0, -1)]
    right = [F.when(slot + d < fan, F.lead("digest", d).over(w)) for d in range(1, fan)]
    nodes = nodes.withColumn("run", F.floor(F.col("pos") / F.lit(fan)).cast("long"))
    nodes = nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})
    return nodes.withColumn("alone", (F.col("pos") == 0) & (F.col("right") == ""))


@dataclass
class Tree:
    """``levels``: tables of ``grp``, ``pos`` and ``digest``, leaves first. ``tops``: ``grp``, ``digest`` and the ``level`` it is found at."""

    levels: list[DataFrame]
    tops: DataFrame
    fan: int


def grow(leaves: DataFrame, fan: int = FAN, name: str = "merkle") -> Tree:
    """The trees over leaves with ``grp``, ``pos`` and ``digest``, one for each ``grp``."""
    levels, tops = [leaves], None
    while True:
        nodes = with_siblings(levels[-1], fan)
        level = len(levels) - 1
        done = nodes.filter("alone").select("grp", "digest", F.lit(level).alias("level"))
        tops = done if tops is None else tops.unionByName(done)
        first = nodes.filter((F.pmod("pos", F.lit(fan)) == 0) & ~F.col("alone"))
        parents = materialize(first.select("grp", F.col("run").alias("pos"), F.sha2(F.concat("digest", "right"), 256).alias("digest")), f"{name}-level")
        if not parents.count():
            return Tree(levels, materialize(tops, f"{name}-tops"), fan)
        levels.append(parents)


def paths(tree: Tree, above: DataFrame, carry: list[str], stored: str = "merkle-paths") -> DataFrame:
    """The leaves' rows with ``path``, an array of what stands left and right at each level. ``above``: per ``grp`` the path that goes on
    from its top, and the columns of ``carry``, which every node gets."""
    down = None
    for level in range(len(tree.levels) - 1, -1, -1):
        # what is all that is left of its group goes on with the path above the group
        ends = tree.tops.filter(F.col("level") == level).select("grp").join(above, "grp").select("grp", F.lit(0).cast("long").alias("run"), "path", *carry)
        upper = ends if down is None else ends.unionByName(down.select("grp", F.col("pos").alias("run"), "path", *carry))
        nodes = with_siblings(tree.levels[level], tree.fan).join(upper.withColumnRenamed("path", "_upper"), ["grp", "run"])
        own = F.when(F.col("alone"), F.slice("_upper", 1, 0)).otherwise(F.array(F.struct("left", "right")))
        down = nodes.withColumn("path", F.concat(own, "_upper")).drop("_upper", "run", "left", "right", "alone")
        if level:
            down = materialize(down.select("grp", "pos", "path", *carry), stored)
    return down


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings along a path."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda x: F.array(x["left"], x["right"]))), ""), 256)


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, altered: Callable[[dict[str, Column]], Column] | None = None, fan: int = FAN
) -> DataFrame:
    """Per row: ``id``, ``leaf``, ``subroot``, ``root`` and ``path``.

    ``altered`` makes, from the fields' columns by name, the leaf that is found when the document is looked at again, null where it is unchanged; it comes back as
    ``seen_leaf``, and folding it shows whether the document is still the one of the manifest.
    """
    columns = {c: F.col(c) for c in fields}
    seen = altered(columns) if altered else F.lit(None)
    leaves = docs.select(F.col(id_col).alias("id"), group_key(F.col(group_col)).alias("grp"), leaf_of(list(columns.values())).alias("digest"), seen.cast("string").alias("seen_leaf"))
    leaves = materialize(placed(materialize(leaves, "merkle-leaves"), ["grp"], ["id", "digest"]), "merkle-placed")
    groups = grow(leaves, fan)
    subroots = placed(groups.tops.select(F.col("grp").alias("name"), "digest"), [], ["name"]).withColumn("grp", F.lit(""))
    whole = grow(materialize(subroots, "merkle-subroots"), fan, "merkle-root")
    root = whole.tops.first()
    end = whole.tops.select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = paths(whole, end, []).select(F.col("name").alias("grp"), "path", F.col("digest").alias("subroot"))
    down = paths(groups, materialize(above, "merkle-above"), ["subroot"])
    return down.select("id", F.col("digest").alias("leaf"), "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "path", "seen_leaf")


def lower_letters(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(c: dict[str, Column]) -> Column:
    """The leaf of a document whose letters were lowered, for every fifth document; null for the others, and for a null id."""
    hit = F.crc32(c["doc_id"].cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf_of([lower_letters(v) if k == "text" else v for k, v in c.items()]))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    out = manifest(read(spark, folder, "documents", *FIELDS), altered=tampered)
    out = out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.coalesce("seen_leaf", "leaf"), F.col("path")).alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _written_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_written_sql(text if c == "text" else c) for c in FIELDS) + ")"


_CRC = (
    "xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda h, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],"
    " lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(h, b)), 4294967295::BIGINT))"
)
SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, source, {_leaf_sql("text")} AS leaf,
  CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE NULL END AS seen FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
a(lvl, grp, pos, n, h) AS (SELECT 0, coalesce('=' || source, ''), pos, n, leaf FROM placed
  UNION ALL SELECT lvl + 1, grp, pos // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY pos)) FROM a WHERE n > 1 GROUP BY lvl, grp, pos // {FAN}, n),
top AS (SELECT grp, h, lvl, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n FROM a WHERE n = 1),
b(lvl, pos, n, h) AS (SELECT 0, pos, n, h FROM top
  UNION ALL SELECT lvl + 1, pos // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY pos)) FROM b WHERE n > 1 GROUP BY lvl, pos // {FAN}, n),
nodes AS (SELECT 0 AS tree, * FROM a WHERE n > 1 UNION ALL SELECT 1, lvl, '', pos, n, h FROM b WHERE n > 1),
sib AS (SELECT tree, lvl, grp, pos, coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, grp, pos // {FAN} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, grp, pos // {FAN} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM nodes),
start AS (SELECT p.*, t.pos AS gpos, t.h AS subroot, (SELECT h FROM b WHERE n = 1) AS root FROM placed p JOIN top t ON t.grp = coalesce('=' || p.source, '')),
step AS (SELECT s.id, row_number() OVER (PARTITION BY s.id ORDER BY x.tree, x.lvl) AS k, l, r FROM start s JOIN sib x ON (x.tree = 0 AND x.grp = coalesce('=' || s.source, '') AND x.pos = s.pos // (1 << (4 * x.lvl)))
  OR (x.tree = 1 AND x.pos = s.gpos // (1 << (4 * x.lvl)))),
f(id, k, h, proof) AS (SELECT id, 0, coalesce(seen, leaf), '' FROM start UNION ALL SELECT f.id, f.k + 1, sha256(l || h || r), proof || l || r FROM f JOIN step ON step.id = f.id AND step.k = f.k + 1),
last AS (SELECT id, arg_max(h, k) AS folded_root, arg_max(proof, k) AS proof FROM f GROUP BY id)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM start JOIN last USING (id)
"""
QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLES = {"op11_merkle_manifest": SQL}
