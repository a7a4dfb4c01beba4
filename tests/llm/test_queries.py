"""The registered queries on the smallest tables, against brute force."""

import base64
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_operators import brute_components, brute_kneser_ney, shingles_of

from ledgerloom.llm import fingerprint, langid, quality, secret_scan
from ledgerloom.llm.queries import ORACLES, QUERIES, trusted_ids, vocabulary


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, tables, name):
    got = QUERIES[name](spark, SMALL)
    cursor = tables.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cursor.fetchall())


def test_jaccard_query(spark, tables):
    """The registered query on a small table, against all pairs."""
    docs = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op3_jaccard_join"](spark, SMALL).collect()}
    parts = brute_components([(i, t or "") for i, t in docs.items()])
    assert {i: r["component_id"] for i, r in got.items()} == parts
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles_of(t)) if t else 0 for i, t in docs.items()}


def test_bpe_query(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    for r in QUERIES["op5_bpe"](spark, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_fingerprint_query(spark, tables):
    docs = tables.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op10_fingerprint"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(text)
        assert 0 <= got[i]["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.4 > 0.1 > np.mean([r["near_next"] for r in got.values()])


def test_fingerprint_strings(spark, tables):
    """Strings and likenesses of the query, from bottom-128 sketches made in Python of the same shingle hashes."""
    docs = tables.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    edited = [(i, t[: len(t) - len(t) // 4] + n[: len(t) // 4]) for (i, t), (_, n) in zip(docs, docs[1:] + docs[:1], strict=True)]

    def sketches(rows):
        df = spark.createDataFrame(rows, "i bigint, t string").select("i", fingerprint.shingle_hashes(F.col("t")).alias("h"))
        return {r["i"]: sorted(set(r["h"]))[:128] for r in df.collect()}

    def likeness(a, b):
        union = sorted({*a, *b})[:128]
        return len({*union} & {*a} & {*b}) / len(union) if union else 1.0

    own, other = sketches(docs), sketches(edited)
    encoded = lambda a: base64.b64encode(b"".join(int(x).to_bytes(6, "big") for x in a)).decode()
    got = {r["doc_id"]: r for r in QUERIES["op10_fingerprint"](spark, SMALL).collect()}
    for (i, _), (n, _) in zip(docs, docs[1:] + docs[:1], strict=True):
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (encoded(own[i]), encoded(other[i]))
        assert (r["near_edited"], r["near_next"]) == (likeness(own[i], other[i]), likeness(own[i], own[n]))


def test_quality_query(spark, tables):
    """The registered query on the whole table: a row a document, and what it keeps is what the filter lets through."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, SMALL).collect()}
    assert len(rows) == docs.count()
    passed = {r["doc_id"] for r in quality.accepted(docs.withColumn("kept", F.lit(None).cast("string")), trusted_ids(spark, SMALL)).select("doc_id").collect()}
    assert {i for i, r in rows.items() if r["kept"]} == passed
    assert all(r["kept"] == (r["log_perplexity"] is None or r["limit"] is None or r["log_perplexity"] <= r["limit"]) for r in rows.values())


def test_language_query(spark, tables):
    truth = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op8_language"](spark, SMALL).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.9


def test_secrets_query(spark, tables):
    """Base spans by the contract's rules, written anew; every other span is of a format, and none of those overlaps a base span."""
    texts = dict(tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    rules = (("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32))
    rows = QUERIES["op9_secrets"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        spans = [(m.start(), k, m.end(), kind) for k, (kind, rule, group, least) in enumerate(rules) for m in re.finditer(rule, texts[r["doc_id"]]) if len(m[group]) >= least]
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        shown = [s.split(":") for s in r["spans"].split(",") if s]
        assert [s for s in shown if s[0] != "format"] == [s.split(":") for s in base.split(",") if s]
        for _, a, b in (s for s in shown if s[0] == "format"):
            assert all(int(b) <= x or y <= int(a) for x, _, y, _ in spans)


def test_language_query_reads_only_text(spark, tables):
    """Other columns never reach a prediction: with lang and source taken away from held-out documents all stays as it was."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.train(docs.filter(~held))
    bare = langid.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model)
    want = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op8_language"](spark, SMALL).collect()}
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in bare.collect()} == want


def test_packing_query(spark, tables):
    """Every id of every document lies in exactly one piece, sequences are gapless, full or a power of two."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    docs = dict(tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    pieces, sequences = {}, {}
    for r in QUERIES["op4_packing"](spark, SMALL).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == docs.keys()
    for i, text in docs.items():
        ids, at = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and (ends[-1] == 4096 or ends[-1] & (ends[-1] - 1) == 0 and ends[-1] < 4096)


def test_pipeline_against_brute_force(spark, tables, tmp_path):
    """Every stage on what its predecessor kept, each compared with a plain Python version of its decision."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    columns = [c[0] for c in tables.execute("SELECT * FROM documents LIMIT 0").description]
    docs = {r[0]: dict(zip(columns, r, strict=True)) for r in tables.execute("SELECT * FROM documents").fetchall()}
    labels = {i: (q, t) for i, q, t in tables.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "secret scans", "packing"]

    def run(name, given):
        path = str(tmp_path / name.replace(" ", "-"))
        stage[name](spark, given, SMALL).write.parquet(path)
        out = spark.read.parquet(path)
        return out, {r["doc_id"]: r.asDict() for r in out.collect()} if "text" in out.columns else out.collect()

    # 1: held-out quantile of the excess over the allowance, under a model of the other trusted texts
    trusted = [i for i, (q, t) in labels.items() if q == 1 and not t and i in docs]
    held = {i for i in trusted if zlib.crc32(str(i).encode()) % quality.FOLDS == 0}
    model = brute_kneser_ney([docs[i]["text"] or "" for i in trusted if i not in held])
    excess = {i: -np.mean([model(r["text"], k) for k in range(len(r["text"]))]) - 2 / len(r["text"]) ** 0.5 for i, r in docs.items() if r["text"]}
    quantile = lambda own: sorted(own)[max(0, int(np.ceil(0.995 * len(own))) - 1)]
    by_lang = {}
    for i in held & excess.keys():
        by_lang.setdefault(docs[i]["lang"], []).append(excess[i])
    overall = quantile([excess[i] for i in held & excess.keys()])
    limit = {lang: quantile(own) for lang, own in by_lang.items() if len(own) >= 50}
    want = {i for i, r in docs.items() if not r["text"] or excess[i] <= limit.get(r["lang"], overall) + 1e-9}
    frame, got = run("quality classifier", spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert frame.columns == columns and got == {i: docs[i] for i in want}

    # 2: the largest identifier of each text
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    best = {}
    for i, r in got.items():
        best[fold(r["text"])] = max(i, best.get(fold(r["text"]), i))
    frame, got = run("exact dedup", frame)
    assert frame.columns == columns and set(got) == set(best.values())

    # 3: the smallest identifier of each component
    parts = brute_components([(i, r["text"] or "") for i, r in got.items()])
    frame, got = run("n-gram Jaccard join", frame)
    assert frame.columns == columns and set(got) == set(parts.values())

    # 4: every base span goes, and all other text stays in order
    before = got
    frame, got = run("secret scans", frame)
    assert frame.columns == columns and got.keys() == before.keys()
    grammar = secret_scan.learn(spark.createDataFrame([(i, r["text"]) for i, r in before.items()], "doc_id long, text string"))
    for i, r in got.items():
        text = before[i]["text"]
        gone, shown, at = sorted((a, b, k) for a, b, k, _ in grammar.spans(text or "")), "", 0
        for a, b, kind in gone:
            if a >= at:
                shown += (text or "")[at:a] + f"<secret:{kind}>"
            at = max(at, b)
        assert r["text"] == (None if text is None else shown + text[at:]) and r["n_chars"] == len(r["text"] or "")
        assert not secret_scan.base_spans(r["text"] or "")

    # 5: every id of every document once
    library = Tokenizer.from_file(vocabulary())
    _, pieces = run("packing", frame)
    sizes = {i: len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for i, r in got.items()}
    lengths = {}
    for r in pieces:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == sizes
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.columns == list(pieces[0].asDict()) and {r["doc_id"] for r in whole.collect()} == set(sizes)
