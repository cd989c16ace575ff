"""Predictions and scores of the trained models against plain loops over whole texts."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import regex
import zstandard
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import attention, language, queries


def test_language_equals_a_plain_loop(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, None), (-2, "", None), (-3, "12 34", None), (-4, "́̀", None), (-5, "A", None), (-6, "word " * 40_000, None)], docs.schema)
    docs = docs.unionByName(odd)
    model = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert len(model) > 1
    coders = {}
    for lang, content in model.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coders[lang] = zstandard.ZstdCompressor(level=6, dict_data=held, write_content_size=False, write_dict_id=False)
    for doc_id, text, _ in docs.collect():
        letters = " ".join(regex.findall(r"[\p{L}\p{M}]+", (text or "").lower()))
        if not regex.search(r"\p{L}", letters):
            assert (got[doc_id].lang_pred, got[doc_id].score, got[doc_id].rejected) == ("und", 0.0, True)
            continue
        sizes = {lang: len(coder.compress(letters.encode())) for lang, coder in coders.items()}
        first, second = sorted(sizes.values())[:2]
        assert sizes[got[doc_id].lang_pred] == first
        assert got[doc_id].margin == pytest.approx((second - first) / first)
        assert got[doc_id].rejected == (second - first < 0.02 * first)


def plain_score(ids, w, classes, rest):
    """log10 probability of ids: one place at a time, one key at a time, in the window that scores the place."""
    w = {k: x.astype(float) for k, x in w.items()}
    before, total = [ids[-1], *ids[:-1]], 0.0  # the end id comes before the first
    members = w["member_bias"].shape[1]
    for p, target in enumerate(ids):
        start = p // 24 * 24 - 8
        x = {j: w["embed"][classes[before[j]]] + w["place"][j - start] for j in range(max(0, start), p + 1)}
        query = x[p] @ w["query"] / 4
        weight = {j: math.exp(query @ (x[j] @ w["key"])) for j in x}
        mixed = sum(weight[j] * (x[j] @ w["value"]) for j in x) / sum(weight.values())
        h = np.maximum(x[p] @ w["direct"] + mixed @ w["mixed"] + w["shift"], 0)
        group, member = divmod(classes[target], members)
        for logits, chosen in ((h @ w["group"] + w["group_bias"], group), (h @ w["member"][group] + w["member_bias"][group], member)):
            total += logits[chosen] - math.log(np.exp(logits).sum())
        total += rest.get(target, 0.0)
    return total / math.log(10)


def test_score_equals_a_plain_loop_over_places(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vocabulary = "river stone unbelievable it's 1234 naïve x-ray ok".split()
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (0, 1, 7, 15, 16, 23, 40, 120)] + [None, "never seen before, zebra"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    kept = {}

    def fitted(docs, vocabulary, n_ids, tokenizer):
        w = attention.start_weights(vocabulary.bias)
        kept["w"] = {k: x + np.float32(0.2) * np.random.default_rng(1).standard_normal(x.shape).astype(np.float32) if k != "member_bias" else x for k, x in w.items()}
        return kept["w"]

    monkeypatch.setattr(attention, "fit", fitted)
    got = {r.doc_id: r.score for r in attention.score(docs, F.col("doc_id") == 9).collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    counts = Counter(i for one in ids[:9] for i in one)
    ranked = sorted(counts, key=lambda i: (-counts[i], i))
    classes = {i: k for k, i in enumerate(ranked)}
    unseen = attention.IDS - len(ranked)
    rest = {i: -math.log(unseen) for one in ids for i in one if i not in classes}
    classes |= {i: len(ranked) for i in rest}
    assert rest
    for i, one in enumerate(ids):
        assert got[i] == pytest.approx(plain_score(one, kept["w"], classes, rest), rel=1e-4, abs=1e-3)


def test_training_beats_word_and_pair_frequencies_on_held_out_texts(spark):
    """Sentences of a small grammar whose next word depends on the word before last."""
    rng = np.random.default_rng(5)
    nouns, verbs = [f"noun{chr(97 + i)}" for i in range(12)], [f"verb{chr(97 + i)}" for i in range(12)]

    def text():
        k, out = rng.integers(12), []
        for _ in range(60):
            out += [nouns[k], "then" if rng.random() < 0.5 else "soon", verbs[k]]
            k = (k + 1 + rng.integers(2)) % 12
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(1200)], "doc_id long, text string")
    rows = attention.score(docs, F.col("doc_id") % 10 == 0).where("held_out").collect()
    total = sum(r.score for r in rows)
    held, taught = ([r.text.split() for r in docs.collect() if (r.doc_id % 10 == 0) == flag] for flag in (True, False))
    pairs, single = Counter(p for t in taught for p in zip(t, t[1:])), Counter(x for t in taught for x in t)
    by_pairs = sum(math.log10((pairs[a, b] + 0.1) / (single[a] + 0.1 * len(single))) for t in held for a, b in zip(t, t[1:]))
    assert total > sum(r.base_score for r in rows)
    assert total > by_pairs
    assert not re.search("nan|inf", str([r.score for r in rows]))
