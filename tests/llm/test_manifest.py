"""The manifest of hashes against a plain tree."""

import hashlib
import math
import zlib

from trialweave.llm import merkle_manifest as mm

FIELDS = mm.FIELDS


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def fold_up(nodes, fan):
    """(top, siblings left and right of each leaf by level)."""
    ways = [[] for _ in nodes]
    owner = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + fan, len(nodes))) for k in range(0, len(nodes), fan)]
        for run in runs:
            for k in run:
                for x in owner[k]:
                    ways[x].append(("".join(nodes[run.start : k]), "".join(nodes[k + 1 : run.stop])))
        owner = [[x for k in run for x in owner[k]] for run in runs]
        nodes = [H(*nodes[run.start : run.stop]) for run in runs]
    return (nodes[0] if nodes else None), ways


def plain(rows, fan=16):
    groups = {}
    for r in rows:
        groups.setdefault("" if r["source"] is None else "=" + r["source"], []).append((leaf([r[c] for c in FIELDS]), r))
    subs = {}
    for g, members in groups.items():
        members.sort(key=lambda x: (-math.inf if x[1]["doc_id"] is None else x[1]["doc_id"], x[0]))
        subs[g] = (*fold_up([m[0] for m in members], fan), members)
    names = sorted(subs, key=str.encode)
    root, above = fold_up([subs[g][0] for g in names], fan)
    out = []
    for g, more in zip(names, above):
        sub, ways, members = subs[g]
        for (own, r), way in zip(members, ways):
            h = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                low = r["text"] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
                h = leaf([low if c == "text" else r[c] for c in FIELDS])
            for left, right in way + more:
                h = H(left, h, right)
            out.append((r["doc_id"], own, sub, root, H(*[s for pair in way + more for s in pair]), h, h == root))
    return out


def manifest_rows(df, fan=16):
    from pyspark.sql import functions as F

    out = mm.manifest(df, altered=mm.tampered, fan=fan)
    out = out.select("id", "leaf", "subroot", "root", mm.proof_digest(F.col("path")), mm.folded(F.coalesce("seen_leaf", "leaf"), F.col("path")).alias("f"))
    return [(*tuple(r), r["f"] == r["root"]) for r in out.collect()]


def same(df, fan=16):
    rows = [r.asDict() for r in df.select(*FIELDS).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(manifest_rows(df, fan), key=key) == sorted(plain(rows, fan), key=key)


def test_odd_rows(odd):
    same(odd)


def test_several_levels(spark):
    rows = [(k, "aé"[k % 7 == 0] if k % 5 else None, "en", k, f"Text {k % 40} É") for k in range(150)] + [(3, "z", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same(df, fan=3)
    same(df.filter("source = 'z'"))
    same(df.filter("source = 'a'"), fan=16)


def test_many_groups(spark):
    rows = [(k, f"s{k}", None, None, "x") for k in range(40)]
    same(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), fan=4)


def test_nothing(none):
    out = mm.manifest(none)
    assert out.columns == ["id", "leaf", "subroot", "root", "path", "seen_leaf"] and out.count() == 0
