"""Hard negatives, token alignment and HTML extraction against brute force, and on odd rows."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.llm import align, hard_negatives, html_extract
from ledgerloom.llm.queries import QUERIES, vocabulary

# ---- hard negatives --------------------------------------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=3, low=50, high=95):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), from all pairs."""
    rows = [r for r in rows if None not in r[:3] and None not in r[2]]
    out = []
    for i, label, v, anchor in rows:
        if not anchor:
            continue
        scored = sorted(((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, w, strict=False)))), j, m) for j, m, w, _ in rows if j != i), key=lambda s: s[:2])
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fine = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, j, k, n, -s, -t) for k, (t, n, _) in enumerate(fine, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, vector array<bigint>, asked boolean").withColumns({c: F.lit("x") for c in ("id", "part", "block", "data", "score", "rank", "tree", "place")})
    found = hard_negatives.mine(df, F.col("asked"), **how)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def vectors(rng, n, d=8, spread=40, centres=6):
    middle = rng.integers(-60, 60, (centres, d))
    return [(i, int(rng.integers(0, 3)), (middle[rng.integers(centres)] + rng.integers(-spread, spread, d)).tolist(), bool(i % 9 == 0)) for i in range(n)]


def test_negatives_of_many_trees(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 90)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 25)
    rows = vectors(np.random.default_rng(1), 700)
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, rows, positives=2, negatives=4, low=20, high=99) == brute_negatives(rows, 2, 4, 20, 99)


def test_negatives_with_ties_and_copies(spark):
    """One vector is a third of all rows; others tie too."""
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), [50, 50, 0] if i % 3 else rng.integers(-2, 3, 3).tolist(), i % 7 == 0) for i in range(400)]
    rows = [(i, label, [x * (1 + label) // 2 for x in v], a) for i, label, v, a in rows]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 60, d=4)
    rows += [(None, 1, [1, 2, 3, 4], True), (100, None, [1, 2, 3, 4], True), (101, 1, None, True), (102, 1, [1, None, 3, 4], True), (103, 1, [], True), (104, 2, [7, 7], True), (105, 2, [7] * 9, True), (106, 0, [0, 0, 0, 0], None)]
    assert mined(spark, rows) == brute_negatives(rows)
    huge = [(i, i % 2, [int(x) << 40 for x in rng.integers(-9, 9, 3)], i < 5) for i in range(40)]
    assert mined(spark, huge) == brute_negatives(huge)
    assert mined(spark, []) == []
    assert mined(spark, [r[:3] + (False,) for r in rows]) == []
    lonely = [(1, 1, [3, 3], True), (2, 2, [2, 2], True)]
    assert mined(spark, lonely) == []


def test_tree_prunes_and_bounds_hold():
    """On clustered rows most products are never taken, and nothing is lost."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-3000, 3000, 16) + rng.integers(-20, 20, (200, 16)) for _ in range(20)])
    ids, labels = np.arange(len(x)), rng.integers(0, 4, len(x))
    tree = hard_negatives.build(ids, labels, x)
    ask = np.arange(0, len(x), 80)
    best, used = hard_negatives.search(tree, ask, labels[ask], x[ask], 5, same=True)
    score = x[ask] @ x.T
    for k, a in enumerate(ask):
        order = sorted((-s, i) for i, s in enumerate(score[k].tolist()) if i != a and labels[i] == labels[a])[:5]
        assert [(-s, i) for s, i in zip(best.score[k].tolist(), best.id[k].tolist(), strict=True)] == order
    assert used < 0.3 * len(ask) * len(x)


# ---- token alignment -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a_file, b_file = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    a = Tokenizer.from_file(a_file)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    shown = {c: n for n, c in enumerate(align.byte_symbols())}
    a_bytes = lambda i: bytes(shown[c] for c in a.id_to_token(i)) if i != 50256 else a.id_to_token(i).encode()
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def brute_groups(both, text):
    a, b, a_bytes, b_bytes = both
    if not text:
        return None
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if b"".join(map(a_bytes, x)) != (" " + text).encode() or b"".join(map(b_bytes, y)) != (" " + text).encode():
        return None
    groups, i, j, at, bt = [], 0, 0, 0, 0
    while i < len(x):
        left, right = [x[i]], [y[j]]
        at, bt, i, j = at + len(a_bytes(x[i])), bt + len(b_bytes(y[j])), i + 1, j + 1
        while at != bt:
            if at < bt:
                left.append(x[i])
                at, i = at + len(a_bytes(x[i])), i + 1
            else:
                right.append(y[j])
                bt, j = bt + len(b_bytes(y[j])), j + 1
        groups.append((left, right))
    return x, y, groups


def brute_alignment(both, rows):
    found = [(i, brute_groups(both, t)) for i, t in rows]
    links = [(i, f, Counter((p, q) for left, right in f[2] for p in left for q in right) if f else Counter()) for i, f in found]
    held = Counter(pair for _, _, c in links for pair in c)
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    out = []
    for i, f, c in links:
        sha = hashlib.sha256(";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in f[2]).encode()).hexdigest() if f else ""
        sizes = (len(f[0]), len(f[1]), len(f[2])) if f else (0, 0, 0)
        out.append((i, *sizes, sum(c.values()), sum(n for pair, n in c.items() if held[pair] == top[pair[0]]), sum(n * held[pair] for pair, n in c.items()), sha))
    return sorted(out, key=str)


FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("id", "slice", "n_a", "codes", "docs", "held", "at", "value", "place")})
    got = align.align(df, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    assert got.columns == FIELDS
    return sorted(map(tuple, got.collect()), key=str)


def odd_texts():
    rng = random.Random(5)
    odd = [None, "", " ", "  a", "a  b", "\n a \n b", "x▁y", "<|endoftext|> hi <s></s>", "é ① ﬁ  z", " a", "a ", "a" * 3000, "\t\tq\r\n w", "日本語 テスト 🙂🙂 x", "don't  we'll 've", "\x00 a\x00b", "same", "same"]
    return odd + ["".join(rng.choice(" \n\tab12é▁.,<>日🙂 　") for _ in range(rng.randrange(1, 50))) for _ in range(200)] + [" ".join(rng.choice(("of", "the", "house", "unlikely", "x9")) for _ in range(9000))]


def test_alignment_of_odd_texts(spark, both, monkeypatch):
    rows = [*enumerate(odd_texts()), (3, "repeated"), (3, "repeated"), (None, "no id")]
    want = brute_alignment(both, rows)
    assert aligned(spark, rows) == want
    # many links: lots within a slice, and documents with more links than a lot
    aligner = align.Aligner(align.byte_level_side(open(vocabulary("byte_bpe_50k.json")).read()), align.piece_side(open(vocabulary("piece_bpe_32k.model"), "rb").read()))
    texts = [t for _, t in rows]
    whole = aligner.slice(texts)
    monkeypatch.setattr(align, "AT_ONCE", 50)
    small = aligner.slice(texts)
    key = lambda r: [sorted(zip(r["codes"][r["at"][e - h : e]].tolist(), r["times"][e - h : e].tolist(), strict=True)) for e, h in zip(np.cumsum(r["held"]), r["held"], strict=True)]
    assert key(whole) == key(small)
    # a full cache changes nothing
    monkeypatch.setattr(align, "WORDS", 20)
    aligner = align.Aligner(aligner.a, aligner.b)
    again = aligner.slice(texts)
    assert again["groups_sha256"] == whole["groups_sha256"] == aligner.slice(texts)["groups_sha256"] and len(aligner.encoder.slot) == 20
    assert aligned(spark, []) == []


def test_alignment_query(spark, both):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    got = QUERIES["op12_token_alignment"](spark, SMALL)
    assert sorted(map(tuple, got.select(*FIELDS).collect()), key=str) == brute_alignment(both, rows)


# ---- HTML extraction -------------------------------------------------------------------------------------------------


def test_blocks_of_markup():
    page = """<!doctype html><HTML><head><title>no</title><script>var t="</p>";</script><style>p{}</style></head><body class="Page-Main">
    <p>one &amp; two&nbsp;&lt;b&gt;<p>three <b>bold</i></b><br>four<!-- <p>gone</p> --></p>tail <a href="x>y" title='q'>link</a>
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table><script>x<y</script><textarea>no</textarea><pre>  e
      f </pre> 1 < 2 <x-own>g</x-own><div/>h"""
    found = html_extract.blocks(page)
    assert [b[0] for b in found] == ["one & two <b>", "three bold four", "tail link", "a", "b", "c", "d", "e f", "1 < 2 g", "h"]
    assert found[2][3] == 4 and found[3][2] == "li" and found[0][2] == "p"
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<p>  <br> </p>") == []
    assert [b[0] for b in html_extract.blocks("<p>cut off <b")] == ["cut off"]
    assert [b[0] for b in html_extract.blocks("<p>a<!-- open")] == ["a"]
    assert [b[0] for b in html_extract.blocks("<script>never closed <p>x")] == []
    assert len(html_extract.blocks("<div>" * 5000 + "<p>x</p>" * 5000)) == 5000


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.train(spark.read.parquet(f"{SMALL}/pages.parquet"))


def article(page):
    """The given pages' articles by their one template; brute force for these pages only."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in p else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(p for p in parts if p)


def test_html_query(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall())
    got = QUERIES["op13_html_text"](spark, SMALL).collect()
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        assert (r["text"], r["n_chars"]) == (article(pages[r["page_id"]]), len(r["text"]))


def test_labeller_on_unseen_layouts(labeller):
    """Composed pages with another seed: blocks right, over all and among boilerplate and main text apart."""
    pages, labels = html_extract.layouts(["Some words of prose that go on for a while, and then some more of them.", "Short words"], 200, seed=77)
    truth = np.array([y for page in labels for y in page])
    said = labeller.scores(html_extract.features(pages)) > 0.5
    assert (said == truth).mean() > 0.97 and (said[truth == 1]).mean() > 0.97 and (~said[truth == 0]).mean() > 0.95


def test_labeller_on_written_pages(labeller):
    """Pages written by hand, in markup of several kinds."""
    prose = "The ferry left the harbour before dawn, and nobody on the pier could say who had been at the wheel that day."
    rest = '<p>Later reports were less certain; two witnesses had seen a light on the upper deck, others none.</p>'
    menu = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
    foot = '<footer>© 2024 Harbour Times. All rights reserved</footer>'
    pages = [
        f"<body>{menu}<main><h1>The ferry</h1><p>{prose}</p>{rest}</main>{foot}",
        f'<body><div id="header">Harbour Times</div><div class="navbar"><a href="/">Home</a> <a href="/x">Sport</a></div><div class="article-body"><h1>The ferry</h1><p>{prose}</p>{rest}</div><div class="sidebar"><h3>Related</h3><a href="/q">Storm warning</a></div>{foot}',
        f'<body><div class="cookie-banner">We use cookies. <button>Accept</button></div>{menu}<article><h1>The ferry</h1><p>{prose}</p><div class="ad">Buy a boat</div>{rest}</article><section id="comments"><h3>2 comments</h3><div class="comment"><p>I was there and saw it with my own eyes.</p></div></section>{foot}',
        f'<body>{menu}<article><h1>The ferry</h1><p>{prose}</p>{rest}<form class="newsletter"><label>Your email</label><button>Subscribe</button></form></article>{foot}',
    ]
    want = ["The ferry", prose, "Later reports were less certain; two witnesses had seen a light on the upper deck, others none."]
    for page in pages:
        found = html_extract.blocks(page)
        kept = labeller.scores(html_extract.features([found])) > 0.5
        assert [b[0] for b, k in zip(found, kept, strict=True) if k] == want


def test_gradients_are_right():
    pages, labels = html_extract.layouts(["A few words.", "Rather more words than that, and a comma or two, to have a longer one."], 4, seed=3)
    model = html_extract.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    f, y = html_extract.features(pages), np.array([v for page in labels for v in page], np.float32)
    _, g = model.gradients(f, y)
    for k, v in model.p.items():
        at = np.unravel_index(np.argmax(np.abs(g[k])), v.shape)
        old, step = v[at], 1e-3
        v[at] = old + step
        up = model.gradients(f, y)[0]
        v[at] = old - step
        down = model.gradients(f, y)[0]
        v[at] = old
        assert abs(g[k][at] - (up - down) / (2 * step)) < 1e-4 + 1e-2 * abs(g[k][at])


def test_extraction_of_odd_rows(spark, labeller):
    page = "<article><p>Hello there, this is a text.</p></article><nav><a>Home</a></nav>"
    long = "<article>" + "".join(f"<p>Sentence number {k} of a very long page, with a comma.</p>" for k in range(4000)) + "</article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "", ""), (None, "v", page), (4, "w", long), (5, "x", "no markup at all, only a text."), (6, "y", "<<<>>> &#0; &bogus; &#x1F642;")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("z") for c in ("id", "text", "n_chars", "h", "t", "n_main")})
    got = html_extract.extract(df, labeller)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"]
    found = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"], r["n_blocks"]) for r in got.collect()), key=str)
    assert len(found) == len(rows) and found.count((1, "u", "Hello there, this is a text.", 28, 2)) == 2 and (2, None, "", 0, 0) in found and (3, "", "", 0, 0) in found
    assert next(r for r in found if r[0] == 4)[2].count("\n") == 3999
    empty = spark.createDataFrame([], df.schema)
    assert html_extract.extract(empty, html_extract.train(empty)).count() == 0
