"""The registered queries and the pipeline, held against the stages' plain meaning."""

import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as P
from planweave.llm import neardup, pieces, pii, quality, queries


def test_names_and_sql():
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n.split("_")[0][2:]))] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_registered_sql(spark, data):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    for name, sql in queries.ORACLE.items():
        got = queries.QUERIES[name](spark, data)
        r = con.execute(sql)
        names = [d[0] for d in r.description]
        text = lambda v: repr(round(v, 9)) if isinstance(v, float) else str(v)
        assert sorted(names) == sorted(got.columns), name
        assert sorted(tuple(text(row[names.index(c)]) for c in got.columns) for row in r.fetchall()) == sorted(tuple(text(v) for v in row) for row in got.collect()), name


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    good = P.quality_stage(spark, docs, data)
    assert good.columns == docs.columns
    kept = quality.classify(docs, labels.select("doc_id", "quality")).where("kept").select("doc_id")
    assert sorted(good.select("doc_id").collect()) == sorted(kept.collect())
    unique = P.near_duplicate_stage(spark, good, data)
    assert unique.columns == docs.columns
    want = neardup.near_duplicates(good).where("kept").select("doc_id").distinct()
    assert sorted(unique.select("doc_id").collect()) == sorted(want.collect())
    clean = P.pii_stage(spark, unique, data)
    assert clean.columns == docs.columns and clean.count() == unique.count()
    assert all(not pii.base_spans(r.text) for r in clean.collect() if r.text) and clean.where("n_chars <> length(text)").count() == 0
    mixed = P.mixing_stage(spark, clean, data)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 3").count() == 0
    out = P.encoding_stage(spark, mixed, data)
    assert out.count() == mixed.count() and out.where("text is not null and not round_trip").count() == 0


def test_run_and_awkward_rows(spark, data, tmp_path):
    out = P.run(spark, data)
    assert set(P.COLUMNS) <= set(out.columns) and out.count() > 0
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, "a b c", None, None, None), (900001, None, "en", None, None), (900002, "", "en", "z", 0), (900003, "twice " * 30, "en", "z", 180), (900003, "twice " * 30, "en", "z", 180)], docs.schema)
    docs = docs.unionByName(odd)
    unique = P.near_duplicate_stage(spark, docs, data)
    assert unique.where("doc_id is null").count() == 1 and unique.where("doc_id = 900003").count() == 1
    for _, stage in P.STAGES:
        assert stage(spark, docs, data).count() > 0
        assert stage(spark, docs.limit(0), data).count() == 0
    assert P.pii_stage(spark, docs, data).where(F.col("doc_id") == 900001).first().text is None


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_features(text):
    """A text's features, byte by byte and word by word."""
    data = (text or "").encode()
    n, words = max(len(data), 1), WORD.findall(text or "")
    if not words:
        return [0.0] * len(quality.TEXT_FEATURES)
    low, up, digit = (sum(a <= c <= b for c in data) for a, b in ((97, 122), (65, 90), (48, 57)))
    blank, high = sum(c == 32 or 9 <= c <= 13 for c in data), sum(c >= 128 for c in data)
    odd = lambda c: c < 128 and not chr(c).isalnum() and c != 32 and not 9 <= c <= 13 and chr(c) not in ".,;:'\"-()"
    ws = [w.encode() for w in words]
    k = len(ws)
    lower = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in ws]
    share = lambda flags: sum(flags) / k
    bad = [sum(map(odd, w)) for w in ws]
    lines = data.count(10) + 1
    return [
        (low + up + high) / n, digit / n, (n - low - up - digit - blank - high) / n, up / n / max((low + up) / n, 1e-9), blank / n, high / n, min(sum(map(len, ws)) / k, 30) / 30, share(len(w) > 20 for w in ws),
        share(a == b for a, b in zip(lower[1:], lower)), len(set(lower)) / k, max(Counter(lower).values()) / k, share(b > 0 for b in bad), share(b == len(w) for b, w in zip(bad, ws)), min(k / lines, 400) / 400,
        share(w[-1:] in (b".", b"!", b"?") for w in ws), sum(odd(b) and a == b for a, b in zip(data, data[1:])) / n,
    ]


def plain_meta(source, lang, text):
    def slot(name, value):
        h = xxhash.xxh64_intdigest((value if value is not None else "\0").encode(), seed=xxhash.xxh64_intdigest(name.encode(), seed=42))
        return (h - (1 << 64) if h >> 63 else h) % quality.META_FEATURES

    return [slot("source", source), slot("lang", lang), np.float32(np.log1p(len((text or "").encode())))]


def plain_score(model, text, meta):
    logs = []
    for m, x, (slope, offset) in zip(model.models, (text, meta), model.scale):
        z, at = m.weights[0], 1
        x = [float(np.float32(v)) for v in x]
        if m.hashed:
            z, at, x = z + m.weights[1 + int(x[0])] + m.weights[1 + quality.META_FEATURES + int(x[1])], 1 + 2 * quality.META_FEATURES, x[2:]
        for v, cuts in zip(x, m.cuts):
            z, at = z + m.weights[at + sum(c <= v for c in cuts)], at + len(cuts) + 1
        logs.append(slope * max(-12.0, min(12.0, z)) + offset)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(logs) - math.log(model.prior / (1 - model.prior))))))


def plain_unique(rows):
    """Of each group of rows linked by 4 in 5 of their five-word shingles, those of the least id."""
    sets = {}
    for r in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(r["text"] or "")]
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    common, held = Counter(), defaultdict(list)
    for i in sorted(sets):
        for g in sets[i]:
            for j in held[g]:
                common[j, i] += 1
            held[g].append(i)
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return [r for r in rows if root(r["doc_id"]) == r["doc_id"]]


def plain_mix(rows, cycle=(5, 2, 1), most=3):
    """Every document as often as its source's target takes it, the last one in part."""
    by = defaultdict(list)
    for r in rows:
        t = r["text"] or ""
        letters = sum(unicodedata.category(c)[0] == "L" for c in t)
        draw = hashlib.md5(f"mix:{r['doc_id']}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
        weight = ((letters + 1.0) / (len(t) + 1.0)) ** 2
        by[r["source"]].append((-math.log((int(draw[:13], 16) + 0.5) / (1 << 52)) / weight, r["doc_id"], len(WORD.findall(t)), r))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(x[2] for x in by[s]) for s in names}
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    target, free, words = {}, list(names), sum(size.values())
    while True:  # by hand: whoever would pass its cap stops there, the others share again
        level = words / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] >= most * size[s]]
        if not over:
            break
        for s in over:
            target[s] = float(most * size[s])
            words -= most * size[s]
            free.remove(s)
    target |= {s: level * weight[s] for s in free}
    out = []
    for s in names:
        budget = round(target[s])
        epochs, rest = divmod(budget, size[s]) if size[s] else (0, 0)
        for _, _, n, r in sorted(by[s], key=lambda x: x[:2]):
            part = max(0, min(n, rest))
            rest -= part
            out += [(r["doc_id"], r["text"])] * (epochs if n else 0)
            if part:
                out.append((r["doc_id"], r["text"] if part == n else " ".join(WORD.findall(r["text"])[:part])))
    return out


def test_run_against_a_plain_version(spark, data):
    """The whole pipeline worked out in plain Python; only the fitted weights are the operators' own."""
    import sentencepiece

    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    feats = quality.features(docs)
    rows = [r.asDict() for r in docs.collect()]
    views = {r.doc_id: (r.view_text, r.view_meta) for r in feats.collect()}
    for r in rows:
        assert views[r["doc_id"]][0] == pytest.approx(plain_features(r["text"]), abs=1e-5) and views[r["doc_id"]][1] == pytest.approx(plain_meta(r["source"], r["lang"], r["text"]), abs=1e-5)
    model = quality.fit(feats, labels)
    good = [r for r in rows if plain_score(model, *views[r["doc_id"]]) >= 0.5]
    unique = plain_unique(good)
    spans = pii.fit(spark.createDataFrame([(r["text"],) for r in unique], "text string"))
    for r in unique:
        if r["text"]:
            base, found = pii.find(r["text"], spans, 0.9)
            assert set(base) <= set(found)
            covered, out, at = sorted(found, key=lambda x: (x[1], -x[2])), "", 0
            for kind, a, b in covered:
                if a >= at:
                    out += r["text"][at:a] + f"<{kind.upper()}>"
                at = max(at, b)
            r["text"] = out + r["text"][at:]
    want = Counter(plain_mix(unique))
    got = P.run(spark, data).collect()
    assert Counter((r.doc_id, r.text) for r in got) == want
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(r.ids == sp.encode(r.text) and r.round_trip for r in got) and 0 < len(unique) < len(good) < len(rows)
