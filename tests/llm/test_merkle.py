"""The Merkle manifest against trees built one node at a time."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.llm import merkle
from tests.llm.test_rows import rows


def sha(text):
    return sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """Root, and per leaf its levels as (left, right) digests."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i in range(len(leaves)):
            start = at[i] - at[i] % 3
            paths[i].append(("".join(level[start:at[i]]), "".join(level[at[i] + 1:start + 3])))
            at[i] //= 3
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(table):
    def leaf(r):
        return sha("".join("-" if r[f] is None else f"{len(str(r[f]).encode())}:{r[f]}"
                           for f in ("doc_id", "source", "lang", "n_chars", "text")))

    def later(r):
        if r["doc_id"] is None or r["text"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2:
            return r
        return {**r, "text": r["text"].replace("\n", "")}
    sources = {}
    for r in table:
        sources.setdefault(r["source"], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in names:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        own[s] = brute_tree([leaf(r) for r in sources[s]])
    if not names:
        return []
    root, above = brute_tree([own[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for r, path in zip(sources[s], own[s][1]):
            now = leaf(later(r))
            for left, right in path + up:
                now = sha(left + now + right)
            out.append({"doc_id": r["doc_id"], "leaf": leaf(r), "subroot": own[s][0], "root": root,
                        "proof_sha256": sha("".join(a + b for a, b in path + up)),
                        "folded_root": now, "verified": now == root})
    return out


def order(table):
    return sorted(table, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"],
                                        r["proof_sha256"]))


def test_addresses_are_a_layout():
    for levels in range(1, 8):
        every = np.concatenate([merkle.addresses(levels, d) for d in range(levels)])
        assert sorted(every) == list(range(merkle.slots(levels)))
        assert merkle.addresses(levels, 0)[0] == 0
    # Two levels above two: the upper tree, then nine lower ones, each in one stretch.
    for child in range(9):
        start = 4 + 4 * child
        assert merkle.addresses(4, 2)[child] == start
        assert list(merkle.addresses(4, 3)[3 * child:3 * child + 3]) == [start + k for k in (1, 2, 3)]


@pytest.mark.parametrize("n, rise", [(1, 0), (1, 3), (2, 1), (3, 1), (4, 2), (10, 3), (27, 3), (80, 4)])
def test_block(n, rise):
    digests = [sha256(str(i).encode()).digest() for i in range(n)]
    level, steps = [d.hex() for d in digests], [[] for _ in digests]
    for t in range(rise):
        for i in range(n):
            p = i // 3 ** t
            run = level[p - p % 3:p - p % 3 + 3]
            run[p % 3] = "*"
            steps[i].append("".join(run) + ";")
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    block = merkle.layout(digests, rise)
    assert len(block) == 32 * merkle.slots(rise + 1) and block[:32].hex() == level[0]
    assert merkle.paths(bytes(block), n, rise) == ["".join(s) for s in steps]


@pytest.mark.parametrize("height", [2, 6])
def test_manifest(spark, docs, monkeypatch, height):
    """Blocks of few levels make many rounds, small chunks cut the numbering of a source."""
    monkeypatch.setattr(merkle, "ROWS_PER_CHUNK", 16 if height == 2 else 1 << 14)
    monkeypatch.setattr(merkle.manifest, "__defaults__", (None, height))
    table = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").when(
        F.col("doc_id") % 2 == 0, F.col("source")))
    got = rows(merkle.verified(table))
    want = brute(rows(table))
    assert order(got) == order(want)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_odd(odd, empty):
    for table in (odd, odd.withColumn("source", F.when(F.col("doc_id") > 5, "").otherwise(None)),
                  odd.limit(1), empty):
        got = rows(merkle.verified(table))
        assert order(got) == order(brute(rows(table)))


def test_any_change_of_a_leaf_is_found(spark, docs):
    made = merkle.manifest(docs)
    proved = merkle.proofs(made)
    wrong = F.sha2(F.concat("leaf", F.lit("x")), 256)
    got = proved.select(merkle.folded(F.col("leaf"), F.col("proof")).alias("a"),
                        merkle.folded(wrong, F.col("proof")).alias("b"), "root")
    assert got.filter("a <> root OR b = root").count() == 0 and got.count() == docs.count()
