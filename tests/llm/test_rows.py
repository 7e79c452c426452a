"""Operators that judge each document (or pair) against brute force, on data and odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from sonde.cluster import scratch_path
from sonde.llm import (components, decontaminate, langid, packing, pii, sharding, simhash,
                       tokenfile)
from sonde.llm.queries import BYTE_BPE, QUERIES, WORD_BPE, table


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- sharding -------------------------------------------------------------------------------

def test_lookup_table_is_filled_by_turns():
    shards, slots = ("a", "b", "c"), 13
    table, order = [None] * slots, {}
    for i, s in enumerate(shards):
        number = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:15], 16)
        offset, skip = number(f"offset:{s}") % slots, number(f"skip:{s}") % (slots - 1) + 1
        order[i] = [(offset + j * skip) % slots for j in range(slots)]
        assert sorted(order[i]) == list(range(slots))
    turn = 0
    while None in table:
        slot = next(s for s in order[turn % 3] if table[s] is None)
        table[slot] = turn % 3
        turn += 1
    assert sharding.lookup_table(shards, slots) == table
    assert sorted(Counter(table).values()) == [4, 4, 5]


def test_a_lost_shard_moves_few_slots():
    full = sharding.lookup_table()
    less = sharding.lookup_table(sharding.SHARDS[:-1])
    assert max(Counter(full).values()) - min(Counter(full).values()) <= 1
    moved = sum(a != b for a, b in zip(full, less) if a != 63)
    assert moved < 0.05 * len(full)
    for bad in [(), ("a", "a")]:
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 7)
    with pytest.raises(ValueError):
        sharding.lookup_table(("a",), 8)


def test_sharding_odd(odd, empty):
    got = rows(sharding.placed(odd))
    assert len(got) == odd.count() and all(r["shard"] in sharding.SHARDS for r in got)
    assert sharding.placed(empty).count() == 0
    plan = sharding.placed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- components and SimHash ---------------------------------------------------------------------

def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    links += [(i, i + 1) for i in range(1000, 1070)] + [(5000, i) for i in range(4000, 4100)]
    links += [(7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    clean = [(a, b) for a, b in links if a is not None and a != b]
    want = brute_components({n for link in clean for n in link}, clean)
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert got.count() == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs, corpus):
    spark_hash = spark.sql("SELECT xxhash64('abc def ghi') AS h").first()["h"]
    assert spark_hash % 2**64 == xxhash.xxh64_intdigest(b"abc def ghi", 42)
    fps = {i: brute_fingerprint(t) for i, t in corpus.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = brute_components(fps, near)
    got = {r["doc_id"]: r for r in rows(simhash.near_duplicates(docs))}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want and near


@pytest.mark.parametrize("group", [4, 1024])
def test_near_links_are_exact_for_any_group_size(spark, group):
    rng = np.random.default_rng(5)
    centre, fps = int(rng.integers(0, 2**63)), set()
    for _ in range(150):  # one dense cluster, chains, and strangers
        fps.add(centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))))
        fps.add(int(rng.integers(0, 2**63)))
    x = centre
    for _ in range(30):
        x ^= 1 << int(rng.integers(0, 64)) | 1 << int(rng.integers(0, 64))
        fps.add(x)
    fps = dict(enumerate(sorted(fps)))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in fps.items()]
    points = spark.createDataFrame(signed, "id long, fp long")
    got = {r["node"]: r["root"] for r in
           components.components(simhash.near_links(points, 3, group)).collect()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = brute_components(fps, near)
    assert {i: got.get(i, i) for i in fps} == want


def test_simhash_odd(odd, empty):
    got = rows(simhash.near_duplicates(odd))
    assert len(got) == odd.count()
    zero = [r for r in got if r["doc_id"] in (0, 1, 2)]
    assert all(r["fingerprint"] == "0" * 16 and r["component_id"] == 0 for r in zero)
    assert {r["component_id"] for r in got if r["doc_id"] == 5} == {4}
    assert simhash.near_duplicates(empty).count() == 0


# --- languages ----------------------------------------------------------------------------------

def test_language_accuracy_on_held_out(spark, docs):
    data = table(spark, "/root/testdata/sf0.01", "documents")
    langs = {r["doc_id"]: r["lang"] for r in data.select("doc_id", "lang").collect()}
    got = rows(langid.predict(data, langid.fit(data)))
    assert len(got) == len(langs) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.97


def test_kernel_matches_sets():
    a, b = "Straße im Wald", "im wald und auf der strasse"

    def sets(text):
        data = text.lower().encode()
        flags, at, out = langid.presence(text), 0, []
        for width in langid.RANGES:
            out.append(set(np.flatnonzero(flags[at:at + width]).tolist()))
            at += width
        assert out[0] == set(data)
        return out
    want = np.mean([len(x & y) / np.sqrt(len(x) * len(y)) for x, y in zip(sets(a), sets(b))])
    got = langid.normed(np.stack([langid.presence(a), langid.presence(b)]))
    assert abs(float(got[0] @ got[1]) - want) < 1e-5


def test_languages_odd(odd, empty):
    got = {r["doc_id"]: r for r in rows(langid.predict(odd, langid.fit(odd)))}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 10)] == ["und"] * 4
    assert got[3]["lang_pred"] == "en" and got[None]["held_out"] is False
    kept = langid.accepted(odd, langid.fit(odd))
    assert kept.columns == odd.columns and {0, 1, 2, 10}.isdisjoint(
        {r["doc_id"] for r in kept.collect()})
    assert langid.fit(empty) is None
    assert langid.predict(empty, None).count() == 0
    assert {r["lang_pred"] for r in rows(langid.predict(odd, None))} == {"und"}


# --- decontamination ----------------------------------------------------------------------------

def test_decontamination(spark, docs, corpus, folder):
    items = {r["item_id"]: decontaminate.words(r["text"]) for r in
             table(spark, folder, "benchmark").collect()}
    want = set()
    for i, text in corpus.items():
        own = decontaminate.words(text)
        vocabulary = {w: n + 1 for n, w in enumerate(sorted(set(own)))}
        for item, words in items.items():
            if len(words) < 5:
                continue
            tiles = decontaminate.tiling([vocabulary[w] for w in own],
                                         [vocabulary.get(w, 0) for w in words])
            if sum(n for _, _, n in tiles) >= 0.5 * len(words):
                want.add((i, item))
    got = rows(decontaminate.contaminated(docs, table(spark, folder, "benchmark")))
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want
    blocks = rows(decontaminate.contaminated(docs, table(spark, folder, "benchmark"),
                                             block_bytes=500))
    assert sorted(map(str, blocks)) == sorted(map(str, got))


def brute_tiling(text, item, least):
    """Greedy string tiling without Karp-Rabin: the longest unmarked match, again and again."""
    free_t, free_i, covered = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for t in range(len(text)):
            for p in range(len(item)):
                n = 0
                while (t + n < len(text) and p + n < len(item) and text[t + n] == item[p + n] > 0
                       and free_t[t + n] and free_i[p + n]):
                    n += 1
                if n > best[0]:
                    best = (n, t, p)
        n, t, p = best
        if n < least:
            return covered
        free_t[t:t + n], free_i[p:p + n] = [False] * n, [False] * n
        covered += n


def test_tiling_covers_what_brute_force_covers():
    rng = np.random.default_rng(1)
    for _ in range(60):
        item = rng.integers(1, 8, 40).tolist()
        text = item[20:] + rng.integers(0, 8, 15).tolist() + item[:20]
        tiles = decontaminate.tiling(text, item, 3)
        assert all(text[t:t + n] == item[p:p + n] and n >= 3 for t, p, n in tiles)
        for side in (0, 1):
            places = [k for tile in tiles for k in range(tile[side], tile[side] + tile[2])]
            assert len(places) == len(set(places))
        assert abs(sum(n for *_, n in tiles) - brute_tiling(text, item, 3)) <= 4


def test_decontamination_odd(spark, odd, empty):
    passage = next(r["text"] for r in odd.collect() if r["doc_id"] == 6).split()
    turned = " ".join(passage[60:90] + ["zzz"] + passage[30:60] + passage[:30])
    bench = spark.createDataFrame(
        [(1, turned, 0), (1, turned, 0), (2, None, 1), (3, "", 2), (4, "one", 3), (None, "no id", 4)],
        "item_id long, text string, doc_id int")
    got = rows(decontaminate.contaminated(odd, bench))
    assert {r["doc_id"] for r in got} == {4, 5, 6, 7} and {r["item_id"] for r in got} == {1}
    assert sum(r["doc_id"] == 4 for r in got) == 4  # two rows, two items
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0


# --- personal data ------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(digits[::-1])]
            good = {"email": True, "phone": 9 <= len(digits) <= 15,
                    "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_match_the_plain_patterns(corpus):
    rng = np.random.default_rng(2)
    made = ["".join(rng.choice(list("a1.@-_+ 4(@.9"), 60)) for _ in range(3000)]
    made += ["a@b.c_d@e.f.", "x@y@z.w", "@a.b", "1.2.3.4.5.6.7.8", "001.002.0255.1", "+1 (2",
             "4111-1111 1111-1111", "+49 (30) 12 34 56 78 ", "a" * 5000, "1" * 5000, "@" * 500]
    for text in [*made, *corpus.values()]:
        assert pii.base_spans(text) == brute_spans(text), text[:200]


def test_personal_data(docs, corpus):
    model = pii.fit(docs)
    got = {r["doc_id"]: r for r in rows(pii.personal_data(docs, model))}
    assert len(got) == len(corpus)
    found = 0
    for i, text in corpus.items():
        base = [f"{k}:{a}:{b}" for k, a, b in brute_spans(text)]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i]["spans"].split(","))
        assert got[i]["n_email"] == sum(b.startswith("email") for b in base)
        found += len(base)
    assert found > 10


def test_gradients_match_differences():
    rng = np.random.default_rng(4)
    model = pii.Tagger.fresh(1)
    for p in model.params():
        p[...] = p  # float32 weights, compared loosely
    x, y = rng.integers(0, pii.CODES, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    _, grads = model.gradients(x, y)
    for p, g in zip(model.params(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = p[at], 1e-2
        p[at] = old + eps
        high = model.gradients(x, y)[0]
        p[at] = old - eps
        low = model.gradients(x, y)[0]
        p[at] = old
        assert abs((high - low) / (2 * eps) - g[at]) < 0.05 * max(abs(g[at]), 0.05)


def test_tagger_learns_and_reconciles_windows(docs):
    rng = np.random.default_rng(0)
    words = ["ab", "the", "zu", "de", "year", "12", "v2"]

    def line(with_span):
        parts = rng.choice(words, 14).tolist()
        if with_span:
            parts.insert(int(rng.integers(0, 14)), f"{rng.choice(words)}{rng.integers(9)}@mail.net")
        return " ".join(parts)
    texts = [line(i % 2) for i in range(800)]
    xs = [pii.codes(t, pii.windows(t)) for t in texts]
    ys = [pii.gold_tags(pii.base_spans(t), pii.windows(t)) for t in texts]
    model = pii.train(np.concatenate(xs), np.concatenate(ys), 120)
    hits = total = wrong = 0
    for t in [line(i % 2) for i in range(100)]:
        starts = pii.windows(t)
        got = pii.tagged_spans(t, starts, *model.decode(pii.codes(t, starts)), 0.5) if starts else []
        want = pii.base_spans(t)
        hits += len(set(got) & set(want))
        total += len(want)
        wrong += len(set(got) - set(want))
    assert hits >= 0.9 * total and wrong <= 5
    assert all(b == every for b, every in pii.find(None, texts[:5]))


def test_personal_data_odd(odd, empty):
    model = pii.fit(odd)
    got = {r["doc_id"]: r for r in rows(pii.personal_data(odd, model))}
    assert [got[8][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert got[0]["spans"] == got[1]["spans"] == ""
    hidden = pii.redacted(odd, model)
    assert hidden.columns == odd.columns and hidden.count() == odd.count()
    text = hidden.filter("doc_id = 8").first()["text"]
    assert text.startswith("write to [EMAIL] or [IP] or [CARD] or [PHONE]")
    assert pii.fit(empty) is None and pii.personal_data(empty, None).count() == 0


# --- packing ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_BPE)


def packing_is_right(got, want_ids, capacity):
    lengths, seen = defaultdict(list), defaultdict(list)
    for r in got:
        seen[r["doc_id"]].append(r)
        lengths[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in lengths.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, ids in want_ids.items():
        own = sorted(seen[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k])
                                            for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == capacity for r in own[1:])
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    return len(lengths)


def test_packing(docs, corpus, byte_bpe):
    got = rows(packing.packed(docs, BYTE_BPE))
    ids = {i: [*byte_bpe.encode(t or "", add_special_tokens=False).ids, 2]
           for i, t in corpus.items()}
    used = packing_is_right(got, ids, 1024)
    assert used <= 1.01 * -(-sum(map(len, ids.values())) // 1024) + 1


def test_plans_cover_every_rank():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 1025, 5000), rng.integers(300, 700, 999), rng.integers(1, 5, 3),
                    np.full(70, 1024), np.full(7, 512)):
        histogram = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)]))
        runs = packing.plan(histogram)
        table = packing.placements(runs)
        for n, count in histogram.items():
            own = sorted((a, b) for m, a, b in zip(table["length"], table["first"], table["end"])
                         if m == n)
            assert own[0][0] == 0 and own[-1][1] == count
            assert all(x[1] == y[0] for x, y in zip(own, own[1:]))
        assert all(r.free >= 0 and sum(n * e for n, _, e in r.places) + r.free == 1024
                   for r in runs)
    assert packing.plan({}) == []


def test_packing_odd(odd, empty, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 2)  # lengths ranked in several parts
    got = rows(packing.packed(odd, BYTE_BPE, capacity=64))
    assert sum(r["doc_id"] == 4 and r["piece"] == 0 for r in got) == 2
    packing_is_right(got, {}, 64)
    assert [r["length"] for r in got if r["doc_id"] in (0, 1)] == [1, 1]
    assert packing.packed(empty, BYTE_BPE).count() == 0


# --- token files --------------------------------------------------------------------------------

def test_token_files(spark, docs, corpus):
    from tokenizers import Tokenizer
    tokenizer, start = Tokenizer.from_file(WORD_BPE), 0
    got = {r["doc_id"]: r for r in rows(QUERIES["op8_token_files"](spark, "/root/testdata/sf0.001"))}
    assert len(got) == len(corpus)
    for i in sorted(corpus):
        ids = [*tokenizer.encode(corpus[i] or "", add_special_tokens=False).ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_odd(spark, odd, empty):
    out = scratch_path(spark, "tokens")
    tokenfile.write(odd, out, WORD_BPE, file_bytes=200)
    back = sorted(tokenfile.read(spark, out).collect(), key=lambda r: r["start"])
    assert len(back) == odd.count()
    assert [r["id"] for r in back] == sorted(r["id"] for r in back)
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(back, back[1:]))
    index = spark.read.parquet(f"{out}/index")
    assert index.select("file").distinct().count() > 1
    assert index.select("dictionary").distinct().count() == 1
    got = {r["doc_id"]: r for r in rows(tokenfile.digests(spark, out))}
    assert got[0]["n_tokens"] == got[1]["n_tokens"] == 1
    out = scratch_path(spark, "tokens")
    tokenfile.write(empty, out, WORD_BPE)
    assert tokenfile.digests(spark, out).count() == 0


def test_wide_ids_and_tiny_dictionaries():
    assert tokenfile.serialized(np.array([1, 70000], "<u4").tobytes())[0] == 4
    assert tokenfile.serialized(b"") == (2, b"")
    for data in (b"", b"12345678abcdefgh"):
        d = tokenfile.Dictionary(data)
        assert d.decompressor().decompress(d.compressor().compress(b"abc" * 9)) == b"abc" * 9
