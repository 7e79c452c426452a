"""Operators that find repeats between documents or vectors, against brute force."""

import hashlib
import re

import numpy as np
import pytest

from sonde.llm import neighbors, paragraphs, suffixes
from sonde.llm.queries import table
from tests.llm.test_rows import brute_components, rows


# --- suffixes -----------------------------------------------------------------------------------

def brute_removed(texts, length):
    """{position: (n_bytes, n_removed, n_spans, sha256)} for texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        flags = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            part = data[p:p + length]
            if part in seen:
                flags[p:p + length] = True
            seen.add(part)
        flags = flags[:-1]
        starts = int(flags[:1].sum()) + int((flags[1:] & ~flags[:-1]).sum())
        kept = np.frombuffer(data, np.uint8)[~flags].tobytes()
        out.append((len(data), int(flags.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def check_removed(docs, length, **options):
    got = {r["doc_id"]: r for r in rows(suffixes.removed(docs, length, **options))}
    source = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want = brute_removed([t for _, t in source], length)
    assert len(got) == len(source)
    for (i, _), values in zip(source, want):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == values, i
    return sum(v[1] > 0 for v in want)


def test_suffix_dedup(docs):
    assert check_removed(docs, 100) > 5


def test_suffix_dedup_of_crafted_repeats(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)      # windows across chunk borders
    monkeypatch.setattr(suffixes, "REMEMBERED", 3)   # forgetting changes nothing
    rng = np.random.default_rng(9)

    def noise(n):
        return "".join(rng.choice(list("abcdeé"), n))
    core = noise(400)
    texts = [core, noise(50) + core[100:350] + noise(50), core[:99], core[:100], "x" * 1000,
             "ab" * 300, core[200:] + core[:200], noise(700), "x" * 99, "x" * 100, "", None,
             core + core, noise(130) * 3, core[:150] + "!" + core[151:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert check_removed(docs.repartition(3), 100, bucket_bytes=500) > 8


def test_first_equal_resolves_long_ties():
    rng = np.random.default_rng(2)
    for length in (100, 65, 58):
        data = np.frombuffer(b"".join(bytes(rng.choice([97, 98], 40).astype(np.uint8)) * 6
                                      for _ in range(6)), np.uint8)
        starts = np.arange(len(data) - length + 1)
        order = rng.permutation(len(starts)).astype(np.int64)
        least = {}
        for s, o in zip(starts, order):
            key = data[s:s + length].tobytes()
            least[key] = min(o, least.get(key, o))
        want = [least[data[s:s + length].tobytes()] for s in starts]
        depth = suffixes.cover_ranks(data, length)[1]
        if 1 + depth < length - 8:
            with pytest.raises(ValueError):
                suffixes.first_equal(data, starts, order, length)
        else:
            assert suffixes.first_equal(data, starts, order, length).tolist() == want


def test_suffix_dedup_odd(odd, empty):
    got = rows(suffixes.removed(odd))
    assert len(got) == odd.count()
    four = [r for r in got if r["doc_id"] == 4]
    assert len(four) == 2 and four[0] == four[1] and four[0]["n_removed"] > 0
    five = next(r for r in got if r["doc_id"] == 5)
    assert five["n_removed"] == five["n_bytes"] and five["n_spans"] == 1
    assert next(r for r in got if r["doc_id"] == 0)["n_bytes"] == 0
    assert suffixes.removed(empty).count() == 0


# --- paragraphs ---------------------------------------------------------------------------------

def plain_units(text, reach=paragraphs.REACH):
    """Paragraphs of a text, word by word: (start, end, words)."""
    found = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", text or "")]
    if not found:
        return []
    pair = [int(paragraphs._grams(paragraphs.word_hashes([a[2], b[2]]), 2)[0])
            for a, b in zip(found, found[1:])]
    units, start = [], 0
    for k, h in enumerate(pair):
        if reach <= k < len(pair) - reach and all(h < x for x in pair[k - reach:k]) and all(
                h <= x for x in pair[k + 1:k + 1 + reach]):
            units.append(found[start:k + 1])
            start = k + 1
    units.append(found[start:])
    return [(u[0][0], u[-1][1], [w for _, _, w in u]) for u in units]


def brute_paragraphs(corpus):
    nodes, places = {}, []
    for i, text in sorted(corpus.items()):
        for number, (a, b, words) in enumerate(plain_units(text)):
            key = " ".join(words)
            grams = {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))}
            nodes.setdefault(key, (len(nodes), grams))
            places.append((i, number, a, b, len(words), key))
    index = {}
    for key, (n, grams) in nodes.items():
        for g in grams:
            index.setdefault(g, []).append(n)
    sets = {n: g for n, g in nodes.values()}
    links = set()
    for n, grams in sets.items():
        for m in {m for g in grams for m in index[g] if m > n}:
            if len(grams & sets[m]) >= 0.8 * len(grams | sets[m]) - 1e-9:
                links.add((n, m))
    root = brute_components(sets, links)
    first, gone = {}, set()
    for i, number, a, b, size, key in places:
        r = root[nodes[key][0]]
        if r in first:
            gone.add((i, number, a, b, size, *first[r]))
        first.setdefault(r, (i, number))
    marked = {(i, number) for i, number, *_ in gone}
    return {g for g in gone if g[4] >= 15 or {(g[0], g[1] - 1), (g[0], g[1] + 1)} & marked}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_paragraphs(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    corpus = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = rows(paragraphs.repeated(docs))
    want = brute_paragraphs(corpus)
    have = {(r["doc_id"], r["paragraph"], r["start"], r["end"], r["n_words"], r["kept_doc_id"],
             r["kept_paragraph"]) for r in got}
    assert len(have) == len(got) and len(have & want) >= 0.99 * len(want) and have <= want


def test_every_word_is_in_one_paragraph(corpus):
    for text in corpus.values():
        found, words, cuts = paragraphs.split(text)
        assert len(found) == len(words) == len((text or "").split())
        assert cuts[0] == 0 and cuts[-1] == len(words) and (np.diff(cuts) > 0).all()
        assert len(cuts) < 3 or np.diff(cuts).min() > paragraphs.REACH


def test_passages_are_found_in_any_surroundings(spark):
    """Passages of 51 to 80 words in other lines and sentences; found by words alone, no cuts."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    passages = [[word() for _ in range(int(rng.integers(51, 81)))] for _ in range(60)]
    docs, where = [], {}
    for i in range(240):
        before, after = ([word() for _ in range(int(rng.integers(5, 60)))] for _ in range(2))
        if i < 180:
            middle = passages[i % 60]
            if i // 60 == 1:  # other case, line ends and spaces
                middle = [w.upper() if k % 3 == 0 else w for k, w in enumerate(middle)]
            glue = [" ", "\n", "  "][i // 60]
            head = " ".join(before) + [". ", "\n", " "][i // 60]
            body = glue.join(middle)
            where[i] = (len(head), len(head) + len(body))
            docs.append((i, head + body + " " + " ".join(after)))
        else:
            docs.append((i, " ".join(before + after) + "."))
    got = rows(paragraphs.repeated(spark.createDataFrame(docs, "doc_id long, text string")))
    hit = {r["doc_id"] for r in got}
    assert not hit & set(range(60)) and not hit & set(range(180, 240))
    assert len(hit) >= 0.95 * 120
    for r in got:
        a, b = where[r["doc_id"]]  # a similar paragraph may reach out of the passage a little
        assert min(b, r["end"]) - max(a, r["start"]) >= 0.7 * (r["end"] - r["start"])


def test_similar_sets_match_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sets = []
        for _ in range(4):
            base = rng.choice(400, 40, replace=False)
            for _ in range(12):
                base = base.copy()
                base[rng.integers(0, 40, 3)] = rng.integers(400, 900, 3)
                sets.append(np.unique(base).astype(np.uint64))
        links = [(a, b) for a in range(len(sets)) for b in range(a)
                 if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
        want = brute_components(range(len(sets)), links)
        got = paragraphs._similar(np.arange(len(sets)), sets, 0.8)
        assert brute_components(range(len(sets)), got) == want


def test_large_candidate_groups_are_compared_by_blocks(spark):
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for i in range(40):
        words = list(base)
        words[int(rng.integers(0, 60))] = f"x{i}"
        docs.append((i, " ".join(words)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = paragraphs.occurrences(docs, paragraphs.bands_for(), reach=60)
    small = paragraphs.near_links(docs, found, reach=60, block=4)
    whole = paragraphs.near_links(docs, found, reach=60)
    as_pairs = lambda df: [(r["a"], r["b"]) for r in df.collect()]
    nodes = {n for pair in as_pairs(whole) for n in pair}
    assert len(nodes) == 40
    assert brute_components(nodes, as_pairs(small)) == brute_components(nodes, as_pairs(whole))


def test_rows_compared_do_not_grow_with_the_square_of_a_candidate_group(spark):
    """Sets that chance ties to one root: few meet, and every similar pair does."""
    rng = np.random.default_rng(14)
    base = [rng.choice(10 ** 6, 10, replace=False).astype(np.int64) for _ in range(200)]
    sets = [np.append(b, 7) for b in base] + [np.append(b[1:], 7) for b in base[:60]]
    table = spark.createDataFrame(
        [(5, k, x.tolist()) for k, x in enumerate(sets)],
        "root long, node long, shingles array<long>")
    got = [[m["node"] for m in r["members"]]
           for r in paragraphs.candidate_groups(table, 0.8, block=16).collect()]
    assert max(map(len, got)) <= 2 * 16 and sum(map(len, got)) <= 4 * len(sets)
    met = {(a, b) for g in got for a in g for b in g if a < b}
    assert {(k, 200 + k) for k in range(60)} <= met
    found = paragraphs._verified(paragraphs.candidate_groups(table, 0.8, block=16), 0.8)
    assert {tuple(sorted(r)) for r in found.collect()} == {(k, 200 + k) for k in range(60)}


def test_word_spans_match_a_pattern(corpus):
    for text in [*corpus.values(), "", " ", "a", " a\x1cb\x85c\u3000d\u200be\U0001f600 ", "\x00 \n"]:
        want = [m.span() for m in re.finditer(r"\S+", text or "")]
        assert [tuple(x) for x in paragraphs.word_spans(text or "").tolist()] == want


def test_paragraphs_odd(odd, empty):
    got = rows(paragraphs.repeated(odd))
    assert {r["doc_id"] for r in got} >= {5, 7}
    assert not {0, 1, 2, 3, 10, 13, 14} & {r["doc_id"] for r in got}
    assert paragraphs.repeated(empty).count() == 0
    assert paragraphs.bands_for(0.8, 0.995, 3) == 8 and paragraphs.bands_for() == 6


# --- vectors ------------------------------------------------------------------------------------

def brute_vectors(source):
    n, links = len(source), []
    good = [v is not None and label is not None and len(v) > 0 and None not in v
            and np.isfinite(v).all() and any(v) for _, v, label in source]
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and source[a][2] == source[b][2] and len(source[a][1]) == len(
                    source[b][1]):
                x, y = np.array(source[a][1], float), np.array(source[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links.append((a, b))
    return links


def test_vectors_with_dense_groups_and_several_shards(spark):
    rng = np.random.default_rng(4)
    source = []
    for label, count in ((0, 260), (1, 60)):
        for _ in range(count):
            source.append((len(source), rng.standard_normal(16).tolist(), label))
        centre = rng.standard_normal(16)
        for _ in range(120):  # a dense group, larger than the first beam
            source.append((len(source), (centre + 0.03 * rng.standard_normal(16)).tolist(), label))
    source += [(len(source) + k, source[5][1], 0) for k in range(4)]  # copies
    links = brute_vectors(source)
    want = brute_components(range(len(source)), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(source))
    df = spark.createDataFrame(source, "vec_id long, embedding array<double>, label int")
    for shard in (16384, 150):
        got = {r["vec_id"]: r for r in rows(neighbors.near_duplicates(df, shard=shard))}
        assert len(got) == len(source)
        found = sum(got[i]["n_links"] for i in got)
        assert found >= 0.99 * degree.sum()
        assert all(got[i]["n_links"] <= degree[i] for i in got)
        same = sum(got[i]["component_id"] == want[i] for i in got)
        assert same >= 0.99 * len(got)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vectors_of_the_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    source = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    links = brute_vectors(source)
    got = {r["vec_id"]: r for r in rows(neighbors.near_duplicates(df))}
    degree = np.bincount(np.array(links, int).ravel(), minlength=len(source))
    assert sum(got[v]["n_links"] for v, _, _ in source) >= 0.99 * degree.sum()


def test_vectors_odd(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, [1.0, 0.0], None, "x"),
            (4, None, 1, None), (5, [0.0, 0.0], 1, "x"), (6, [nan, 1.0], 1, "x"),
            (7, [inf, 1.0], 1, "x"), (8, [None, 1.0], 1, "x"), (9, [], 1, "x"),
            (10, [1.0, 0.0, 0.0], 1, "x"), (None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"),
            (12, [1e-300, 0.0], 1, "x"), (13, [1.0, 0.0], 2, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, name string")
    got = rows(neighbors.near_duplicates(df))
    assert len(got) == len(data)
    linked = [r for r in got if r["n_links"]]
    assert sorted(str(r["vec_id"]) for r in linked) == ["1", "1", "12", "2", "None"]
    assert {r["n_links"] for r in linked} == {4} and {r["component_id"] for r in linked} == {None}
    alone = [r for r in got if not r["n_links"]]
    assert all(r["kept"] and r["component_id"] == r["vec_id"] for r in alone)
    assert neighbors.near_duplicates(df.limit(0)).count() == 0
