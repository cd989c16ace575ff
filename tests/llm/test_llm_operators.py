"""Every operator of the subpackage against a brute-force version, SQL, an exact round trip, or held-out accuracy."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import attention, chat, decontaminate, language, lengths, neardup, packing, quality, queries, repeats, stars, urls
from tessera.llm.bytetext import texts
from tessera.llm.subwords import WordEncoder, encoder, pieces

LONG = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam erat sed diam voluptua at vero eos et accusam et justo duo dolores et ea rebum stet clita kasd gubergren no sea takimata sanctus est lorem ipsum dolor sit amet "
TEXTS = [
    None, "", " \n\t ", "one", "Two words", "a b a b a b", "x\ny\nx\n\n y", "ÄÖ ß…, it's <|end|> #5 & |>", LONG, LONG, LONG.upper(), "zz " + LONG * 3 + " q",
    "ab" * 150, "z" * 500, LONG[:150] + "!" + LONG[150:], " ".join(f"w{i}" for i in range(3000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", "extra") for i, t in enumerate(TEXTS)]
    rows += [(None, LONG, "en", None, None), (3, "one", "en", "s1", "again"), (3, "one", "en", "s1", "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_hit string").repartition(3)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_statistics(docs):
    for r in quality.statistics(docs).join(docs.select(F.col("doc_id").alias("id"), "text").distinct(), F.col("doc_id").eqNullSafe(F.col("id"))).collect():
        w = words(r.text)
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)), len(cover))


def mcd(x, cover, steps):
    """The estimator in plain NumPy."""
    floors = np.diag(np.square(quality.FLOORS))
    best = None
    cell = np.sort(np.floor(np.abs(x) * 256 + 0.5) * np.sign(x), axis=0)
    starts = [(x.mean(axis=0), np.cov(x.T, bias=True) * quality._CONSISTENT + floors), (cell[(len(x) - 1) // 2] / 256, np.diag(quality.FLOORS))]
    for m, c in starts:
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            b = np.clip(np.floor(np.log(np.maximum(d, 1e-12)) * quality._BINS), -quality._BIN_LIMIT, quality._BIN_LIMIT)
            inner = x[b <= np.sort(b)[math.ceil(len(x) * cover) - 1]]
            m, c = inner.mean(axis=0), np.cov(inner.T, bias=True) * quality._CONSISTENT + floors
        if best is None or np.linalg.det(c) < best[0] - 1e-12:
            best = np.linalg.det(c), m, c
    return best[1:]


def test_outliers_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(700):
        n, odd = int(np.exp(rng.normal(6, 0.7))) + 50, i % 20 == 0
        source = "hot" if i % 3 else ("mid" if i % 2 else f"rare{i % 40}")
        rows.append((i, "de" if source == "mid" else "en", source, n, n * (9 if odd else 5) + int(rng.integers(n)), int(n * 0.4) if odd else int(rng.integers(3)), 0, 0))
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    got = {r.doc_id: r for r in quality.judge(frame, min_rows=60).collect()}
    assert len(got) == len(rows)
    groups = {}
    size = Counter((r[1], r[2]) for r in rows)
    for r in rows:
        groups.setdefault((r[1], r[2]) if size[r[1], r[2]] >= 60 else r[1], []).append(r)
    for members in groups.values():
        x = np.array([[math.log(r[3]), math.log(r[4] / r[3]), *(math.log1p(100 * v / r[3]) for v in r[5:])] for r in members])
        m, c = mcd(x, quality.COVER, quality.STEPS)
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        for r, want in zip(members, d, strict=True):
            assert got[r[0]].distance == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert {i for i, r in got.items() if not r.kept} == set(range(0, 700, 20))


def test_rows_of_rare_languages_are_judged(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "en" if i < 300 else "odd", "s", n, n * (5 if i != 302 else 60) + int(rng.integers(n)), 0, 0, 0) for i, n in enumerate(rng.integers(100, 900, 304).tolist())]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert len(got) == 304 and all(r.distance is not None for r in got.values()) and not got[302].kept and got[301].kept
    assert all(r.distance is None and r.kept for r in quality.judge(frame.where("doc_id > 250")).collect())


def test_quality_edge_cases(spark, docs):
    judged = quality.judge(quality.statistics(docs))
    assert judged.count() == docs.count()
    kept = quality.reject(docs)
    assert kept.columns == docs.columns and kept.count() == judged.where("kept").count()
    assert quality.judge(quality.statistics(docs.limit(0))).count() == 0


def test_language_held_out(spark, sf_dir):
    rows = queries.op2_language(spark, sf_dir).join(queries.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert rows and sum(r.lang_pred == r.lang for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(docs):
    model = language.fit(docs)
    rows = language.predict(docs, model).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"} and language.predict(docs.limit(0), model).count() == 0


def test_language_is_learned_from_distinct_texts(spark):
    """Copies, and starts without letters, do not thin out what is learned of a language."""
    rows = spark.range(50_000).selectExpr("'de' as lang", "'immer derselbe text' as text").unionByName(spark.range(300).selectExpr("'de' as lang", "concat('wort', id, 'ende') as text"))
    rows = rows.unionByName(spark.createDataFrame([("fr", "1" * 700 + " mot"), ("xx", "123"), ("xx", None)], "lang string, text string"))
    model = language.fit(rows)
    assert list(model) == ["de", "fr"] and model["fr"] == b"mot"
    assert model["de"].count(b"wort") == 300 and model["de"].count(b"immer") == 1
    some = language.fit(rows, sample_docs=50)["de"]
    assert some.count(b"wort") + some.count(b"immer") == 50


def brute_windows(texts, items, size):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))
    patterns = {}
    for k, t in items:
        w = cut(t)
        n = min(len(w), size)
        for i in range(len(w) - n + 1 if n else 0):
            patterns.setdefault(tuple(w[i : i + n]), set()).add(str(k))
    out = []
    for t in texts:
        w, hit, found = cut(t), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in patterns:
                    hit |= set(range(i, i + n))
                    found |= patterns[p]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_windows(spark, docs, block_bytes):
    items = [(1, "dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et"), (2, "Two words"), (3, None), (4, "!"), (5, "b a b"), (5, "b a b"), (6, "erat sed diam")]
    bench = spark.createDataFrame([*items, (None, "one")], "item_id long, text string")
    rows = decontaminate.match_windows(docs, bench, block_bytes=block_bytes).collect()
    want = brute_windows([r.text for r in rows], items, 13)
    assert [(r._match.n_words, r._match.n_hit, r._match["items"]) for r in rows] == want
    assert all(sum(s.end - s.first for s in r._match.spans) == r._match.n_hit for r in rows)
    assert decontaminate.match_windows(docs, bench.limit(0)).agg(F.sum("_match.n_hit")).first()[0] == 0


def test_attention_is_a_distribution():
    counts = np.zeros(attention.IDS, np.int64)
    counts[:3000] = np.arange(3000, 0, -1)
    v = attention.Vocabulary.of(counts)
    w = attention.start_weights(v.bias)
    prefix = np.array([5, 7, 900])
    ids = np.concatenate([np.append(prefix, i) for i in range(attention.IDS)])
    lp = attention.log_probabilities(w, v, attention.windows(ids, np.full(attention.IDS, 4), v))
    assert np.exp(lp[:, 3]).sum() == pytest.approx(1, abs=1e-3)


def test_attention_windows_and_gradients():
    v = attention.Vocabulary.of(np.arange(attention.IDS)[::-1].copy())
    w = {k: x.astype(np.float64) for k, x in attention.start_weights(v.bias).items()}
    ids, sizes = np.random.default_rng(0).integers(0, 1200, 90), np.array([1, 60, 29])
    some = attention.windows(ids, sizes, v)
    assert [int(t) for t in some.targets.ravel() if t >= 0] == ids.tolist()
    # later ids do not change what is scored before them
    w32 = attention.start_weights(v.bias)
    changed = ids.copy()
    changed[40:61] = 3
    before, after = (attention.log_probabilities(w32, v, attention.windows(x, sizes, v)) for x in (ids, changed))
    assert np.allclose(before[1:2], after[1:2], atol=1e-5)
    real = (some.targets >= 0).astype(np.float64)
    classes = v.classes[some.targets]

    def loss():
        lp = attention.log_probabilities(w, attention.Vocabulary(v.classes, np.zeros(attention.IDS), v.bias), some)
        return -(lp * real).sum() / real.sum()

    w.update({k: x.astype(np.float32) for k, x in w.items()})
    grad = attention.gradients(w, some.inputs, some.missing, classes, real)
    for name in ("query", "value", "mixed", "group", "member_bias", "place"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        kept = w[name][at]
        w[name][at] = kept + 0.002
        up = loss()
        w[name][at] = kept - 0.002
        down = loss()
        w[name][at] = kept
        assert (up - down) / 0.004 == pytest.approx(grad[name][at], rel=0.05, abs=1e-4)


def test_scores(docs):
    held = F.col("doc_id") % 4 == 0
    rows = attention.score(docs, held).collect()
    source = docs.collect()
    taught = [r for r in source if r.doc_id is not None and r.doc_id % 4]
    c = Counter(x for r in taught for x in [*words(lower(r.text)), None])
    n, v = sum(c.values()), len(c)
    want = Counter((r.doc_id, len(words(r.text)) + 1, sum(c[x] > 0 for x in [*words(lower(r.text)), None]), round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*words(lower(r.text)), None]), 4)) for r in source)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == want
    assert all(r.train_tokens == n and r.score < 0 for r in rows)
    assert attention.score(docs.limit(0), held).count() == 0


def test_every_id_that_occurs_has_a_class():
    counts = np.zeros(attention.IDS, np.int64)
    counts[100:5100] = np.arange(5000, 0, -1)
    v = attention.Vocabulary.of(counts)
    w = attention.start_weights(v.bias)
    assert len(set(v.classes[100:5100])) == 5000 and (v.rest[100:5100] == 0).all()
    # context tells apart ids that are rare
    ids = np.array([150, 5000, 200, 150, 5001, 200])
    lp = attention.log_probabilities(w, v, attention.windows(ids, np.array([3, 3]), v))
    assert abs(lp[0, 2] - lp[1, 2]) > 1e-6
    every = attention.Vocabulary.of(np.ones(attention.IDS, np.int64))
    assert len(set(every.classes)) == attention.IDS and np.isfinite(every.rest).all()
    assert all(np.isfinite(x).all() for x in attention.start_weights(every.bias).values())


def test_every_text_trains(spark, monkeypatch):
    """At the size of a large corpus each of the texts moves the weights of its ids, and copies are dealt out too."""
    lines = [f"{chr(97 + i % 26)}{chr(97 + i // 26)} x{i}" for i in range(200)] + ["same"] * 100
    ids, lengths_ = encoder().encode(texts(pa.array(lines)))
    v = attention.Vocabulary.of(np.bincount(ids, minlength=attention.IDS))
    monkeypatch.setattr(attention, "SHARD_IDS", 200_000_000, raising=False)
    monkeypatch.setattr(attention, "_SUMMED_AT_ONCE", 2, raising=False)
    start, w = attention.start_weights(v.bias), attention.fit(spark.createDataFrame([(x,) for x in lines], "text string").repartition(3), v, 10**9)
    read = np.setdiff1d(ids, ids[np.cumsum(lengths_) - 1])  # the last id of a text may be input only to its end
    assert len(read) > 20 and np.abs(w["embed"] - start["embed"])[v.classes[read]].max(axis=1).min() > 1e-3


def test_packing(docs):
    tokenizer = encoder().tokenizer
    got = {}
    for r in packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), max_length=64).collect():
        got.setdefault(r.doc_id, []).append(r)
        assert r.length == 2**r.bucket == len(r.ids) // 4 and r.length <= 64 and r.offset == 0
    for i, text in enumerate(TEXTS):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(got[i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == want
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]] and all(r.doc_tokens == len(want) for r in pieces)
    every = packing.digest(packing.pack(docs)).collect()
    assert len({r.sequence_id for r in every}) == len(every)
    assert all(r.ids_crc32 is not None for r in every) and packing.pack(docs.limit(0)).count() == 0


def test_length_limits(docs):
    sizes = [len(encoder().tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    rows = lengths.limits(lengths.histogram(docs), block=16).collect()
    assert {r.length: r.n_docs for r in rows} == Counter(sizes)
    for r in rows:
        longer = [s for s in sizes if s >= r.length]
        assert (r.docs_from, r.tokens_from, r.truncated_tokens) == (len(longer), sum(longer), sum(min(s, r.length) for s in sizes))
        assert r.quantile == pytest.approx(sum(s <= r.length for s in sizes) / len(sizes))
    assert lengths.limits(lengths.histogram(docs.limit(0))).count() == 0


@pytest.mark.parametrize("cache_words", [1000, 250_000])
def test_count_as_the_tables_grow(cache_words):
    """A batch of more new words than the tables have room for, and one after the tables start anew."""
    letters = "abcdefghij"
    names = ["".join(letters[int(d)] for d in f"{i:05d}") for i in range(40_000)]
    column = pa.array([" ".join(names[:35_000]), None, " ".join(names[30_000:])])
    coder = WordEncoder(cache_words=cache_words)
    want = [len(coder.tokenizer.encode(x or "", add_special_tokens=False).ids) for x in column.to_pylist()]
    for _ in range(2):
        assert coder.count(texts(column)).tolist() == want
        assert coder.encode(texts(column))[1].tolist() == want


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 80, (60, 2))] + [("hub", f"n{i}") for i in range(0, 80, 5)]
    parent = {}
    top = lambda x: x if parent.get(x, x) == x else top(parent[x])
    for a, b in pairs:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.id: r.root for r in stars.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {x: top(x) for x in {y for p in pairs if p[0] != p[1] for y in p}}


def test_url_aliases(spark):
    link = lambda t: f"<html><LINK  href='{t}' rel=canonical></html>"
    rows = [
        (1, "http://a.net/x?q=1#f", link("https://b.org.net/y")), (2, "https://b.org.net/y", '<meta http-equiv="refresh" content="0; URL=http://shop.com/de/1">'),
        (3, "http://shop.com/de/1", ""), (4, "http://c.net/", link("/only")), (5, "http://c.net/only", None), (6, None, None), (7, "no url", ""), (8, "http://A.ORG/es/", ""),
        (9, "http://d.net/1", link("http://shop.com/de/2")), (10, "http://e.net/1", link("http://x.com/fr/2")), (11, "http://d.net/1", link("http://e.net/1")), (12, "http://sub.example.org/en/12", ""),
    ]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: v for k, (_, v) in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "allow", 11: "allow", 12: "block"}
    assert got[8][0] == "org/" and got[12][0] == "example.org/en/1" and got[6][0] is None


def brute_links(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}
    top = lambda x: x if parent[x] == x else top(parent[x])
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[max(top(a), top(b))] = min(top(a), top(b))
    return {(i, len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, docs, n):
    rng = np.random.default_rng(4)
    base = [f"v{i}" for i in rng.integers(0, 400, 150)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(100, 220):
        copy = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 22)):
            copy[k] = f"u{rng.integers(1000)}"
        rows.append((i, " ".join(copy)))
    got = neardup.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=n)
    assert {tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()} == brute_links(rows, n, 80)
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert neardup.link(docs).count() == docs.count() and neardup.link(docs.limit(0)).count() == 0


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """Strays and others in blocks so small that some blocks get no stray."""
    monkeypatch.setattr(neardup, "_STRAYS", 100)
    monkeypatch.setattr(neardup, "_OTHERS", 400)
    rng = np.random.default_rng(4)
    base = [f"v{i}" for i in rng.integers(0, 400, 150)]
    rows = []
    for i in range(60):
        copy = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 22)):
            copy[k] = f"u{rng.integers(1000)}"
        rows.append((i, " ".join(copy)))
    got = neardup.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=2)
    assert {tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()} == brute_links(rows, 2, 80)
    assert all(len(x) == 0 for x in neardup.forest(np.zeros(2, bool), np.arange(2), [np.arange(3, dtype=np.uint64)] * 2, 80))


def test_chat_round_trip(spark):
    nasty = ["", "␛", "<|", "|>", "<|>", "<␛|", "␛␛<|end|>\n", "<|turn:user|>\n", "a\nb", "</s>[INST]", "|␛>", "<|␛|>"]
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(zip(itertools.cycle(["user", "assistant", None]), nasty[c:] + nasty[:c]))] + [(9, None, "user", None), (None, 1, "assistant", "x")]
    turns = chat.canonical_turns(chat.group_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "conv_id")
    formatted = chat.format_turns(turns)
    back = formatted.select("canonical", chat.read_turns(chat.formatted_text()).alias("back"), chat.read_loss().alias("loss")).collect()
    assert len(back) == 5
    for r in back:
        assert r.back == r.canonical and r.loss == "".join(t.text for t in r.canonical if t.role == "assistant")


def test_chat_layouts(spark):
    rows = [
        (1, '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}'), (2, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}'),
        (3, '{"instruction":"q","input":"","output":"a"}'), (4, '{"output":"a","instruction":"q"}'), (5, '{"prompt":"q","completion":"a"}'), (6, '{"odd":1}'), (7, "no json"), (8, None),
    ]
    got = {r.id: r for r in chat.canonical_records(spark.createDataFrame(rows, "id long, record string"), "id").collect()}
    assert all([tuple(t) for t in got[i].canonical] == [("user", "q"), ("assistant", "a")] for i in range(1, 6))
    assert all(got[i].canonical is None and got[i].layout is None for i in (6, 7, 8))
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, 2)], "id long, x long"), "id")


def brute_repeats(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = True
        out.append((int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum()), hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_repeats(spark, docs):
    rng = np.random.default_rng(6)
    passage = "".join(map(chr, rng.integers(97, 123, 420)))
    more = ["".join(map(chr, rng.integers(97, 123, rng.integers(0, 300)))) + passage[a:b] + "é" * int(rng.integers(3)) for a, b in rng.integers(0, 420, (40, 2))]
    rows = [*enumerate(TEXTS + more), (None, LONG)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digest(repeats.remove_repeats(frame)).collect()}
    assert got == dict(zip([i for i, _ in rows], brute_repeats([t for _, t in rows], 200), strict=True))
    assert repeats.without_repeats(docs).columns == docs.columns and repeats.remove_repeats(docs.limit(0)).count() == 0


def test_texts_without_repeats_are_made_in_one_pass(spark):
    frame = spark.createDataFrame([(0, "ab" + LONG + "é1"), (1, "cd" + LONG + "è2"), (2, None), (3, "é" * 90)], "doc_id long, text string")
    cut, removed = repeats.without_repeats(frame), repeats.remove_repeats(frame)
    passes = [str(x._jdf.queryExecution().executedPlan()).count("MapInArrow") for x in (cut, removed)]
    assert passes[0] == passes[1], "a second Python worker for each task"
    # the first byte of é and è goes with the repeat, and so the whole character
    assert {r.doc_id: r.text for r in cut.collect()} == {0: "ab1", 1: "cd2", 2: "", 3: "é" * 90}


def test_runs_of_copies_do_not_add_up(spark):
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(97, 123, 900)))
    rows = [(i, text) for i in range(6000)] + [(6000, text[:450]), (6001, "".join(map(chr, rng.integers(97, 123, 900))))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = repeats.repeated_runs(repeats._keyed(frame)).groupBy("k1", "k2").agg(F.sum(F.octet_length("runs")).alias("n"), F.count(F.lit(1)).alias("k")).collect()
    assert found and max(r.n for r in found) < 12 * 900 and max(r.k for r in found) <= 2
    got = {r.doc_id: r.n_removed for r in repeats.digest(repeats.remove_repeats(frame)).collect()}
    assert got == {i: 900 for i in range(6000)} | {6000: 450, 6001: 0}


def test_pipeline_against_brute_force(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = spark.createDataFrame(out.collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        if name == "near duplicates":
            assert set(after) == {i for i, _, c in brute_links([(i, r.text) for i, r in before.items()], 5, 80) if i == c}
        elif name == "long repeats":
            gone = dict(zip(before, brute_repeats([r.text for r in before.values()], 200), strict=True))
            assert all(hashlib.sha256(r.text.encode()).hexdigest() == gone[i][2] or gone[i][0] for i, r in after.items()) and set(after) == set(before)
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
            hit = dict(zip(before, brute_windows([r.text for r in before.values()], items, 13), strict=True))
            assert set(after) == {i for i, (n, h, _) in hit.items() if not (h and 20 * h >= n)}
        else:
            judged = quality.judge(quality.statistics(queries.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")))
            assert set(after) == {r.doc_id for r in judged.where("kept").collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    assert {r.doc_id for r in rows} == set(after)


def test_recurring_words_stay_known():
    coder, asked = WordEncoder(cache_words=300), []
    learn = coder.learn
    coder.learn = lambda words: (asked.extend(words), learn(words))
    common = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    for k in range(30):
        some = [*common, *(f"rare{chr(97 + k)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))]
        ids, lengths = coder.encode(texts(pa.array(some)))
        expected = [coder.tokenizer.encode(w, add_special_tokens=False).ids for w in some]
        assert ids.tolist() == [i for x in expected for i in x] and lengths.tolist() == [len(x) for x in expected]
    # each common word was learned once, and the table has not kept all others
    assert sum(w in set(common) for w in asked) == 100 and len(coder.rows) < 500
    # tables that only hold recurring words start anew
    coder.cache_words = 50
    assert coder.count(texts(pa.array(common))).tolist() == [len(coder.tokenizer.encode(w, add_special_tokens=False).ids) for w in common]


def test_letters_of_latin_1_are_cut_from_punctuation():
    rng = np.random.default_rng(4)
    signs = [*"aZ9'.,;-<|", *"éÉñÿß×÷ÀÞ", "́", "̸", "µ", "ª", "ł", "İ", "…", " "]
    lines = ["".join(rng.choice(signs, 12)) for _ in range(3000)]
    coder = encoder()
    ids, lengths = coder.encode(texts(pa.array(lines)))
    expected = [coder.tokenizer.encode(line, add_special_tokens=False).ids for line in lines]
    assert lengths.tolist() == [len(x) for x in expected] and ids.tolist() == [i for x in expected for i in x]
    words, _ = pieces(texts(pa.array(["café, (Über) 3×4 a÷b"])))
    assert words.to_pylist() == ["café", ",", "(", "Über", ")", "3×4", "a÷b"]
