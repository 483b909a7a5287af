"""The document operators against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from planweave.llm import _blobs, _words, katz, langid, mixing, neardup, pieces, pii, quality, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def make(spark, texts, **cols):
    rows = [(i, t, cols.get("lang", "en"), cols.get("source", "s"), None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows: null and empty texts, white space alone, one word, a long text, copies, a null id, repeated rows."""
    base = " ".join(words(120, 1))
    near = base.split()
    near[60] = "changed"
    texts = [base, " ".join(near), base, None, "", " \t\n\x0b ", "one", "one", "a b c", "A B C", " ".join(words(30_000, 2, 5000)), base + " tail " + " ".join(words(40, 3)), "x y z w", "é É ü"]
    d = make(spark, texts)
    extra = spark.createDataFrame([(None, base, None, None, None), (0, base, "en", "s", 1)], SCHEMA)
    return d.unionByName(extra).withColumns({c: F.lit("clash") for c in ("score", "size", "row", "kept", "taken", "ids", "spans", "batch", "slot")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# words and blobs


def test_words_are_those_of_the_pattern():
    import re

    texts = ["a b", "", " lead", "trail ", "a b c d", "\x1c x\x85y", "é\tü\x0b\x0cz", "w" * 5000]
    data, offsets = _words.buffers(pa.array(texts))
    starts, ends, first = _words.spans(data, offsets)
    got = [[data[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(first, first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_hashes_do_not_depend_on_place():
    data, offsets = _words.buffers(pa.array(["foo bar foo", "bar", "FOO", "oof"]))
    h = _words.Hasher(False).words(data, *_words.spans(data, offsets)[:2])
    low = _words.Hasher(True).words(data, *_words.spans(data, offsets)[:2])
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 4 and low[0] == low[4]


def test_blobs_come_back():
    r = np.random.default_rng(0)
    cols = [r.integers(0, 1 << k, n, dtype=np.uint64) for k, n in ((1, 5), (9, 0), (17, 1000), (40, 3), (63, 77))]
    assert all((a == b).all() for a, b in zip(cols, _blobs.unpack(_blobs.pack(*cols))))
    s = np.sort(cols[2])
    assert (_blobs.undelta(_blobs.delta(s)) == s).all()


# 1 SentencePiece


@pytest.fixture(scope="module")
def model():
    return pieces.load()


def test_ids_equal_the_library(model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    e, d, r = pieces.Encoder(model), pieces.Decoder(model), random.Random(5)
    texts = ["", " ", "  ", "a  b   c", "\n\n x", "日本語 テスト 😀", "x" * 700, "the" * 400, " " * 50 + "hello", "a\tb\r\n  c", "▁▁ ▁", "m² x².y", "$$$ %%%% ***.", "ab" * 5000]
    texts += ["".join(r.choice("abcdethinons \n.,▁é日²$") for _ in range(r.randint(1, 90))) for _ in range(600)]
    for t in texts:
        assert e.ids(t) == lib.encode(t), t[:60]
        assert d.text(e.ids(t)) == lib.decode(lib.encode(t))


def test_windows_commit_without_changing_the_path(model):
    e, r = pieces.Encoder(model), random.Random(6)
    for _ in range(30):
        s = "▁" + "".join(r.choice("etaoinshr") for _ in range(r.randint(100, 600)))
        assert e._walk(s) == model.merge(s)[0]


def test_words_behind_runs_of_spaces_go_through_the_window(model, monkeypatch):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    e, r = pieces.Encoder(model), random.Random(9)
    texts = [" " * n + w for n in range(1, 40) for w in ("the", "日本", "x" * 300, "²", "...", "$", "é", "😀😀")]
    texts += ["".join(r.choice(["  ", "   ", " ", "a", "th", ".", "日", "😀", "\n", "▁"]) for _ in range(r.randint(1, 60))) for _ in range(300)]
    for t in texts:
        assert e.ids(t) == lib.encode(t), t[:60]
    merge, whole = model.merge, []
    monkeypatch.setattr(model, "merge", lambda s: (whole.append(s), merge(s))[1])
    text = " " * 9 + "".join(r.choice("日本語漢字") for _ in range(5000)) + "  " + "".join(r.choice("0123456789abcdef") for _ in range(5000))
    assert pieces.Encoder(model).ids(text) == lib.encode(text) and all(set(s) == {"▁"} for s in whole)


def test_unigram_path_is_the_best(model):
    """The streamed path scores as much as plain Viterbi over the whole text."""
    m = pieces.Pieces(open(pieces.MODEL, "rb").read(), kind=pieces.UNIGRAM)
    e, r = pieces.Encoder(m), random.Random(7)
    for _ in range(40):
        s = "▁" + "".join(r.choice("etaoinshr▁.") for _ in range(r.randint(1, 300)))
        best = [0.0] + [-1e18] * len(s)
        for i in range(1, len(s) + 1):
            for j in range(max(0, i - m.longest), i):
                p = m.index.get(s[j:i])
                if p is not None:
                    best[i] = max(best[i], best[j] + m.scores[p])
        assert sum(m.scores[p] for p in e._walk(s)) == pytest.approx(best[-1])


def test_encode_and_decode(spark, odd, none, model):
    got = pieces.encode(odd, model, checked=True)
    for r in got.collect():
        assert (r.ids is None) == (r.row.text is None) == (r.round_trip is None)
        assert r.ids is None or r.round_trip and r.n_ids == len(r.ids)
    back = pieces.decode(got, model)
    assert back.where("not (row.row.text <=> text)").count() == 0
    assert pieces.encode(none, model).count() == 0


# 2 Substrings


def plain_removal(rows, n=13):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in docs:
        if i is not None:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, w in docs:
        gone = {k + j for k in range(len(w) - n + 1) if i is not None and least[tuple(w[k : k + n])] < i for j in range(n)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def test_substrings(spark, odd, none):
    got = substrings.dedup_substrings(odd, texts=True, slots=3).collect()
    want = plain_removal([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == want
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert {r.longest_repeat for r in got if r.doc_id in (0, 2)} == {104}
    assert substrings.dedup_substrings(none, slots=2).count() == 0


def test_substrings_overlap_and_long_copies(spark):
    a = words(600, 11, 10_000)
    texts = [" ".join(a), " ".join(a[100:500]), " ".join(words(50, 12) + a[300:320] + words(50, 13)), " ".join(["same"] * 80), " ".join(["same"] * 40), " ".join(a[:12])]
    d = make(spark, texts)
    got = {r.doc_id: r for r in substrings.dedup_substrings(d, slots=5).collect()}
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.values()), key=str) == plain_removal(list(enumerate(texts)))
    assert got[1].longest_repeat == 208 and got[2].longest_repeat == 13 and got[4].n_removed == 40 and got[5].n_removed == 0


# 3 Quality


def test_quality_learns_from_labels(spark):
    r = random.Random(3)
    good = [" ".join(f"{w.capitalize()}." if i % 9 == 8 else w for i, w in enumerate(words(r.randint(40, 120), s, 3000))) for s in range(240)]
    junk = [" ".join(w + r.choice(["###", "%%%", "$$$"]) for w in words(r.randint(40, 120), s)) for s in range(60)] + [" ".join([f"w{s}"] * 80) for s in range(60)]
    d = make(spark, good + junk)
    labels = spark.createDataFrame([(i, int(i < 240)) for i in range(360) if i % 3 != 0], "doc_id long, quality int")
    got = quality.classify(d, labels, max_labelled=200, max_exchanged=100)
    right = got.where(F.col("kept") == (F.col("doc_id") < 240)).count()
    assert right >= 355 and got.where("score < 0 or score > 1").count() == 0


def test_quality_of_awkward_rows(spark, odd, none):
    few = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(odd, few, carry=True)
    assert got.count() == odd.count() and got.select("row.*").columns == odd.columns and got.where("not kept").count() == 0
    assert quality.classify(none, few).count() == 0
    assert np.isfinite(quality.text_features(pa.array(["", " ", "a", "é" * 100000, "!" * 50]))).all()


# 5 Personal data


def test_base_spans():
    import re

    r = random.Random(8)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        s = "".join(r.choice("a1.@-+ b2") for _ in range(r.randint(0, 40)))
        assert [(a, b) for k, a, b in pii.base_spans(s) if k == "email"] == [m.span() for m in email.finditer(s)], s
        assert [(a, b) for k, a, b in pii.base_spans(s) if k == "ip"] == [m.span() for m in ip.finditer(s) if all(int(p) <= 255 for p in m[0].split("."))], s
    assert pii.base_spans("4111 1111 1111 1111, 4111 1111 1111 1112") == [("card", 0, 19)]
    assert pii.base_spans("+1 (614) 555-8001.") == [("phone", 0, 17)] and pii.base_spans("+1 2") == []
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []
    assert pii.base_spans("é x@y.zz 256.1.1.1 10.0.0.1") == [("email", 2, 8), ("ip", 19, 27)]


def test_pii_adds_and_redacts(spark, odd, none):
    texts = [f"mail u{i}@host{i}.example.com call +1 (614) 555-{1000 + i} from 10.0.0.{i}" for i in range(40)] + ["phone (614) 555-8001 today", "nothing here", None, ""] + ["+1 (826) 555-4081 190.137.223.204"] * 2
    got = {r.row.doc_id: r for r in pii.find_pii(make(spark, texts)).collect()}
    assert got[0].base_spans == "email:5:26,ip:58:66,phone:32:49" or got[0].n_email == got[0].n_ip == got[0].n_phone == 1
    assert got[0].redacted == "mail <EMAIL> call <PHONE> from <IP>"
    assert got[41].spans == "" and got[42].redacted is None and got[43].spans == ""
    assert got[44].n_phone == 0 and "phone:" in got[44].spans and got[44].spans == got[45].spans
    for r in got.values():
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
    assert pii.find_pii(odd).select("row.*").columns == odd.columns and pii.find_pii(odd).where("spans <> ''").count() == 0
    assert pii.find_pii(none).count() == 0


def plain_base(s):
    """The contract's patterns, word for word."""
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        twice = [int(c) * 2 for c in d[-2::-2]]
        return (sum(int(c) for c in d[::-2]) + sum(x // 10 + x % 10 for x in twice)) % 10 == 0

    out = [("email", *m.span()) for m in email.finditer(s)]
    out += [("ip", *m.span()) for m in ip.finditer(s) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in card.finditer(s) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in phone.finditer(s) if 8 <= len(digits(m)) <= 15]


def test_op5_against_plain_patterns(spark, data):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    got = pii.op5_pii(spark, data).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        want = plain_base(docs[r.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in ("email", "ip", "card", "phone")]
        assert set(filter(None, told.split(","))) <= set(filter(None, r.spans.split(",")))
    assert sum(r.n_email for r in got) and sum(r.n_ip for r in got) and sum(r.n_phone for r in got)


def test_pii_long_texts(spark):
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}.1.2.3") == [("ip", 0, 5006)] and pii.base_spans(f"{zeros}256.1.2.3") == [] and pii.base_spans("1" * 5000 + ".1.2.3") == []
    name = "n" * 1000
    assert pii.wide_spans(f"write {name} (at) host (dot) org") == [("email", 6, 6 + 1000 + 20)]
    many = " ".join(f"call (614) 555-{i % 10000:04d} or m{i}@h{i}.example.org x{i} (at) h (dot) net" for i in range(35_000))
    began = time.time()
    base, spans = pii.find(many, pii.SpanModel({}, np.ones(pii.SLOTS)), 0.5)
    assert len(base) == 35_000 and len(spans) == 105_000 and base == plain_base(many) and time.time() - began < 60
    rows = {r.row.doc_id: r for r in pii.find_pii(make(spark, [many[:400_000], f"{zeros}.1.2.3", None])).collect()}
    assert rows[0].n_email > 5000 and rows[1].base_spans == "ip:0:5006" and rows[2].spans == ""


# 6 Language


def test_language(spark, data, odd, none):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = langid.op6_language(spark, data).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held if r.lang_pred != "und") >= 0.97 * len(held)
    model = langid.learn(docs)
    assert model.langs == ["de", "en", "es", "fr"]
    by = {r.row.text: r for r in langid.identify(odd.limit(20), model).collect()}
    assert by[None].lang_pred == by[""].lang_pred == "und" and by["é É ü"].lang_pred != "und" and all(0 <= r.score <= 1 for r in by.values())
    assert {r.lang_pred for r in langid.identify(odd, langid.learn(none)).collect()} == {"und"} and langid.identify(none, model).count() == 0


def test_mixed_documents_have_several_languages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.learn(docs)
    one = {lang: docs.where(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text for lang in ("en", "de")}
    both = langid.identify(make(spark, [one["en"][:2000] + "\n" + one["de"][:2000], one["de"]]), model).orderBy("row.doc_id").collect()
    assert both[0].lang_set == "de,en" and both[1].lang_set.startswith("de")


def alphabets(names, n, seed):
    """Texts of n words, one a language, that share no letters."""
    r = random.Random(seed)
    return {x: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz"[4 * i : 4 * i + 4]) for _ in range(6)) for _ in range(n)) for i, x in enumerate(names)}


def test_a_set_has_as_many_languages_as_the_text(spark):
    names = ["l0", "l1", "l2", "l3", "l4", "l5"]
    model = langid.learn(spark.createDataFrame(list(alphabets(names, 3000, 1).items()), "lang string, text string"))
    one = alphabets(names, 400, 2)
    texts = [" ".join(one[x] for x in names[:n]) for n in range(1, 7)]
    assert langid.infer(model, pa.array(texts), langid._letter_table())[2] == [",".join(names[:n]) for n in range(1, 7)]


def test_a_small_share_of_a_long_text_counts(spark):
    names = ["l0", "l1", "l2"]
    model = langid.learn(spark.createDataFrame(list(alphabets(names, 3000, 1).items()), "lang string, text string"))
    long, few = alphabets(names, 20_000, 3), alphabets(names, 300, 4)
    assert langid.infer(model, pa.array([long["l0"] + " " + few["l1"], long["l0"]]), langid._letter_table())[2] == ["l0,l1", "l0"]


def test_no_mixture_exceeds_the_bound():
    r = np.random.default_rng(5)
    docs = np.array([0, 1, 40, 400])
    like, base = r.random((400, 5)) ** 4, -r.random(400)
    like /= like.max(axis=1, keepdims=True)
    most = langid._bound(like, base, docs, *langid._mixture(like, base, docs, np.ones((3, 5)), 3))
    assert (langid._mixture(like, base, docs, np.ones((3, 5)), 3000)[1] <= most).all()


# 7 Near-duplicates


def plain_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        if i is not None:
            sets[i] = sets.get(i, frozenset()) | frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[k : k + n]) for k in range(len(w) - n + 1)])
    up = {i: i for i in sets}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates(spark, odd, none):
    got = neardup.near_duplicates(odd, words=4, percent=80).collect()
    want = plain_components([(r.doc_id, r.text) for r in odd.collect()], 4, 80)
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(none).count() == 0


def test_chains_and_large_buckets(spark, monkeypatch):
    """Near copies that drift, so that only neighbours in the chain are linked, in blocks smaller than a bucket."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    r = random.Random(4)
    texts, now = [], words(150, 21, 9999)
    for _ in range(40):
        texts.append(" ".join(now))
        now = list(now)
        for _ in range(2):
            now[r.randrange(len(now))] = f"n{r.random()}"
    base = words(150, 22, 9999)
    for _ in range(60):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"n{r.random()}"
        texts.append(" ".join(w))
    r.shuffle(texts)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(make(spark, texts), words=4).collect()}
    assert got == plain_components(list(enumerate(texts)), 4, 80)


def test_parity_never_overstates():
    r = np.random.default_rng(1)
    a = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (5, 300, 900, 5000)]
    b = [np.unique(np.concatenate([x[: len(x) // 2], r.integers(0, 1 << 63, 40, dtype=np.uint64)])) for x in a]
    every = a + b
    blobs = neardup.parities(np.concatenate(every), np.concatenate([[0], np.cumsum([len(x) for x in every])]))
    for i in range(len(a)):
        true = len(np.setxor1d(a[i], b[i]))
        low = neardup.differ(np.array([i]), np.array([i + len(a)]), blobs)[0]
        assert low <= true and low % 2 == true % 2


# 8 Mixing


def test_mixing(spark, odd, none):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in got) and mixing.mix_sources(none).count() == 0
    r = random.Random(9)
    rows = [(i, " ".join(words(r.randint(0, 60), i)), "en", None if i % 10 == 0 else "hot" if i % 3 else f"s{i % 4}", 0) for i in range(400)]
    d = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, mixing.mix_sources(d, slice_rows=16).collect()), key=str) for _ in range(2))
    assert a == b
    by = {}
    for x in mixing.mix_sources(d, slice_rows=16).collect():
        s = by.setdefault(x.source, [x.source_size, x.target, 0])
        s[2] += x.taken
    assert all(abs(t - k) <= 1 and t <= 3 * n for n, t, k in by.values()) and abs(sum(v[1] for v in by.values()) - sum(v[0] for v in by.values())) < 1e-6
    # Water filling by rounds.
    order = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(v[0] for v in by.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= 3 * by[s][0]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 3.0 * by[s][0]
        left -= sum(target[s] for s in over)
        free -= over
    assert all(by[s][1] == pytest.approx(target[s]) for s in order)


def test_mixed_documents(spark, odd):
    plan = mixing.mix_sources(odd).agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert out.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == plan


# 9 Language model


def test_katz(spark, odd, none, monkeypatch):
    monkeypatch.setattr(katz, "HEAVY", 30)
    texts = [" ".join(words(80, s, 60)) for s in range(40)] + [" ".join(["the"] * 50), "", None, "Unseen words only", "w1 W1 w1"] * 2
    d = make(spark, texts)
    got = katz.score_documents(d, learn=F.col("doc_id") % 10 != 0, slots=3).collect()
    tok = {i: (t or "").encode().translate(LOWER).split() + ["end"] for i, t in enumerate(texts)}
    c, b = Counter(), Counter()
    for i, w in tok.items():
        if i % 10:
            c.update(w)
            b.update(zip(["start", *w[:-1]], w))
    n, v = sum(c.values()), len(c)
    cc = Counter(b.values())
    r = katz.discounted([0] + [cc[k] for k in range(1, 8)])
    less = lambda k: r[k] if k <= katz.CUTOFF else k - katz.LEAST
    p = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    after = {}
    for (u, w), k in b.items():
        after.setdefault(u, []).append((w, k))
    total = {u: sum(k for _, k in f) for u, f in after.items()}
    alpha = {u: (1 - sum(less(k) for _, k in f) / total[u]) / (1 - sum(p(w) for w, _ in f)) for u, f in after.items()}
    for u in list(after)[:20]:
        seen = dict(after[u])
        assert sum(less(seen[w]) / total[u] if w in seen else alpha[u] * p(w) for w in c) + alpha[u] * 0.1 / (n + 0.1 * (v + 1)) == pytest.approx(1)
    assert len(got) == len(texts)
    for x in got:
        w = tok[x.doc_id]
        score = sum(np.log10(less(b[u, y]) / total[u] if (u, y) in b else alpha.get(u, 1.0) * p(y)) for u, y in zip(["start", *w[:-1]], w))
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (x.doc_id % 10 == 0, len(w), sum(c[y] > 0 for y in w), n)
        assert x.base_score == pytest.approx(sum(np.log10(p(y)) for y in w), abs=1e-6) and x.score == pytest.approx(score, abs=1e-6)
    assert katz.score_documents(odd, learn=F.lit(True), slots=2).count() == odd.count()
    assert katz.score_documents(none, learn=F.lit(True), slots=2).count() == 0
    assert katz.score_documents(odd, learn=F.lit(False), slots=2).where("n_known <> 0").count() == 0


def plain_katz(tok, learned):
    """Plain (n_known, N, base score, score) of each token list, and the pieces they come from."""
    c, b = Counter(), Counter()
    for i, w in tok.items():
        if i in learned:
            c.update(w)
            b.update(zip(["start", *w[:-1]], w))
    n, v = sum(c.values()), len(c)
    cc = Counter(b.values())
    r = katz.discounted([0] + [cc[k] for k in range(1, 8)])
    less = lambda k: r[k] if k <= katz.CUTOFF else k - katz.LEAST
    p = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    total, kept, lower = Counter(), Counter(), Counter()
    for (u, w), k in b.items():
        total[u] += k
        kept[u] += less(k)
        lower[u] += p(w)
    alpha = {u: (1 - kept[u] / total[u]) / (1 - lower[u]) for u in total}
    out = {}
    for i, w in tok.items():
        pairs = list(zip(["start", *w[:-1]], w))
        out[i] = (len(w), sum(c[y] > 0 for y in w), n, sum(np.log10(p(y)) for y in w), sum(np.log10(less(b[u, y]) / total[u] if (u, y) in b else alpha.get(u, 1.0) * p(y)) for u, y in pairs))
    return out


def test_op9_against_brute_force(spark, data):
    docs = {r.doc_id: (r.text or "").encode().translate(LOWER) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    tok = {i: [w for w in re.split(rb"[\x20\x09-\x0D]+", t) if w] + ["end"] for i, t in docs.items()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    want = plain_katz(tok, set(docs) - held)
    got = katz.op9_katz(spark, data).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs) and held
    for r in got:
        assert r.held_out == (r.doc_id in held)
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], abs=1e-5) and r.score == pytest.approx(want[r.doc_id][4], abs=1e-5)


def test_katz_with_one_frequent_word_before(spark):
    texts = [" ".join(f"the n{(i * 31 + j) % 977}" for j in range(60)) for i in range(50)]
    got = katz.score_documents(make(spark, texts), learn=F.col("doc_id") % 2 == 0, slots=4).collect()
    want = plain_katz({i: t.encode().split() + ["end"] for i, t in enumerate(texts)}, set(range(0, 50, 2)))
    assert all(r.score == pytest.approx(want[r.doc_id][4], abs=1e-5) for r in got)


def test_mixing_with_a_heavy_tail_of_weights(spark):
    texts = [("a" if i % 5 else "1") * 3 + f" {i}" for i in range(4000)]
    plan = mixing.mix_sources(make(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("x")).otherwise(F.lit("hot"))), slice_rows=16)
    rows = plan.collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for of in by.values():
        budget, size = round(of[0].target), sum(r.size for r in of)
        rest = budget % size
        for r in sorted(of, key=lambda r: (r.sample_key, r.doc_id)):
            part = max(0, min(r.size, rest))
            assert r.taken == budget // size * r.size + part
            rest -= part
        assert sum(r.taken for r in of) == budget


def test_op3_scores_by_hand(spark, data):
    """The query's scores are those of its model, worked out document by document."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    feats = quality.features(docs).cache()
    model = quality.fit(feats, labels)
    want = {}
    for r in feats.collect():
        logs = []
        for m, x, (slope, offset) in zip(model.models, (r.view_text, r.view_meta), model.scale):
            row = [1.0]
            if m.hashed:
                row += [float(x[0] == k) for k in range(quality.META_FEATURES)] + [float(x[1] == k) for k in range(quality.META_FEATURES)]
                x = x[2:]
            for v, cuts in zip(x, m.cuts):
                row += [float(sum(c <= v for c in cuts) == k) for k in range(len(cuts) + 1)]
            logs.append(slope * max(-12.0, min(12.0, sum(a * b for a, b in zip(row, m.weights)))) + offset)
        want[r.doc_id] = 1 / (1 + np.exp(-max(-30.0, min(30.0, sum(logs) - np.log(model.prior / (1 - model.prior))))))
    got = quality.op3_quality(spark, data).collect()
    assert len(got) == len(want) and all(r.score == pytest.approx(want[r.doc_id], abs=1e-9) and r.kept == (r.score >= 0.5) for r in got)
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(r.kept == bool(known[r.doc_id]) for r in got if r.doc_id in known) >= 0.9 * sum(r.doc_id in known for r in got)


def test_op1_against_the_library(spark, data):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    got = pieces.op1_sentencepiece(spark, data).collect()
    assert len(got) == len(docs)
    for r in got:
        t = docs[r.doc_id]
        assert (r.ids, r.n_ids, r.round_trip) == ((None, None, None) if t is None else (sp.encode(t), len(r.ids), True))


def plain_mix64(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def plain_words_in_trigrams(text):
    """Slots of the trigrams of each word: those that end on one of its bytes or right after."""
    letters = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode())
    s, out = b"  " + letters + b"  ", []
    for i in range(len(s) - 2):
        if s[i + 2] != 32 and s[i + 1] == 32:
            out.append([])
        if s[i + 2] != 32 or s[i + 1] != 32:
            out[-1].append(plain_mix64(s[i] << 16 | s[i + 1] << 8 | s[i + 2]) >> 48)
    return out


def test_op6_against_a_plain_version(spark, data):
    """Counts by hand, then every language set of a document, in the order of the full mixture's proportions, by plain EM."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    words_of = {i: plain_words_in_trigrams(r.text or "") for i, r in docs.items()}
    langs = sorted({r.lang for i, r in docs.items() if i not in held and r.lang is not None and r.text is not None})
    counts = {x: Counter() for x in langs}
    for i, r in docs.items():
        if i not in held and r.lang is not None and r.text is not None:
            counts[r.lang].update(s for w in words_of[i] for s in w)
    total = {x: sum(c.values()) + 0.5 * langid.SLOTS for x, c in counts.items()}
    log = {x: lambda s, x=x: float(np.float32(np.log((counts[x][s] + 0.5) / total[x]))) for x in langs}
    known: dict = {}

    def likelihoods(w):
        key = tuple(w)
        if key not in known:
            known[key] = np.array([sum(log[x](s) for s in w) for x in langs])
        return known[key]

    def em(like, allowed):
        share = allowed / allowed.sum()
        for _ in range(12):
            joint = like * share
            share = (joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)).sum(axis=0) / len(like)
        return share, np.log(np.maximum((like * share).sum(axis=1), 1e-30)).sum()

    got = {r.doc_id: r for r in langid.op6_language(spark, data).collect()}
    assert set(got) == set(docs)
    short = sorted(docs, key=lambda i: len(words_of[i]))[:150]
    for i in short:
        r, ws = got[i], words_of[i]
        assert r.held_out == (i in held)
        if not ws or not re.search(r"\w", docs[i].text or ""):
            continue
        word = np.array([likelihoods(w) for w in ws])
        top = word.max(axis=1)
        like = np.exp(np.maximum(word - top[:, None], -60))
        order = np.argsort(-em(like, np.ones(len(langs)))[0], kind="stable")
        single = word.sum(axis=0)
        best, share = single.max(), np.eye(len(langs))[single.argmax()]
        for size in range(2, len(langs) + 1):
            allowed = np.zeros(len(langs))
            allowed[order[:size]] = 1
            s, ll = em(like, allowed)
            if (now := ll + top.sum() - 3.0 * (size - 1) * np.log(len(ws) + 1)) > best + 1e-6:
                best, share = now, s
        assert r.lang_pred == langs[int(share.argmax())] or r.lang_pred == "und", i
        if r.lang_pred != "und" and (share > 0).sum() > 1:
            assert r.score == pytest.approx(float(share.max()), abs=1e-3)
