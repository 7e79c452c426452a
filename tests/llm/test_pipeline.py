"""The pipeline against its stages done by brute force, one document at a time."""

import zlib

import numpy as np

import corpus_pipeline
from sonde.llm import decontaminate, langid, pii
from sonde.llm.queries import BYTE_BPE, table
from tests.llm.test_rows import brute_components, brute_fingerprint, packing_is_right, rows


def test_pipeline(spark, folder, docs, corpus):
    from tokenizers import Tokenizer

    kept = dict(corpus)
    langs = {r["doc_id"]: r for r in rows(langid.predict(docs, langid.fit(docs)))}
    kept = {i: t for i, t in kept.items()
            if langs[i]["lang_pred"] != "und" and langs[i]["score"] >= langid.MIN_SCORE}
    fps = {i: brute_fingerprint(t) for i, t in kept.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    root = brute_components(fps, near)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    items = decontaminate.Items.build(
        [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()],
        decontaminate.TILE)
    kept = {i: t for i, t in kept.items() if not decontaminate.matched(items, t)}
    assert 0 < len(kept) < len(corpus)
    left = spark.createDataFrame([(i, t) for i, t in kept.items()], "doc_id long, text string")
    model = pii.fit(left)
    kept = {i: pii.mask(t, pii.find(model, [t])[0][1]) for i, t in kept.items()}
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in kept.items()}
    got = rows(corpus_pipeline.run(spark, folder))
    assert {r["doc_id"] for r in got} == set(ids)
    packing_is_right(got, ids, 1024)
    whole = [r for r in got if r["length"] == len(ids[r["doc_id"]])]
    assert whole and all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["doc_id"]], "<u4").tobytes())
                         for r in whole)


def test_stages_keep_columns_and_take_odd_rows(spark, folder, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_stages_decide_on_rows(spark, folder):
    """Null and repeated ids, equal rows, and one id for a clean text and a benchmark item."""
    item = table(spark, folder, "benchmark").orderBy("item_id").first()["text"]
    rng = np.random.default_rng(3)
    clean, other = (" ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(60))
                    for _ in range(2))
    data = [(None, item), (1, item), (2, clean), (2, item), (3, clean + " x"), (4, other), (4, other)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = lambda df: sorted(((r["doc_id"], r["text"]) for r in rows(df)), key=str)
    got = kept(corpus_pipeline.decontamination(spark, docs, folder))
    assert got == sorted([(2, clean), (3, clean + " x"), (4, other), (4, other)], key=str)
    # The item's copies are one group (its smallest id is 1), the two equal rows another.
    got = kept(corpus_pipeline.simhash_near_dedup(spark, docs, folder))
    apart = (brute_fingerprint(clean) ^ brute_fingerprint(clean + " x")).bit_count() > 3
    assert got == sorted([(1, item), (2, clean), (4, other)] + [(3, clean + " x")] * apart, key=str)
    clash = docs.withColumnsRenamed({"source": "row", "lang": "group"})
    assert kept(corpus_pipeline.simhash_near_dedup(spark, clash, folder)) == got
