"""The training-data operators against plain versions on small tables with nulls, ties, repeats and clashing columns."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from arborflow.llm import common, fingerprints, forest, language, mixing, neardup, packing, pages, passages, secrets, substrings

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place long, spans string, rank int"


def prose(rng: random.Random, words: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(20)]
    shared = prose(rng, 70)
    near = texts[3].split()
    near[len(near) // 2] = "changed"
    texts += [None, "", "   \n", texts[0], texts[0], " ".join(near), texts[1] + " " + shared, shared + " " + texts[2], prose(rng, 5000), "ÄÖ é €uro 𝄞 𝄞", "<|endoftext|> a\x01b \x01"]
    return [(k, t, "ab"[k % 2] if k % 5 else None, [None, "s1", "s2", "s3"][k % 4], 1, 2, "x", 3) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def test_neardup_against_all_pairs(docs, empty, rows):
    sets = {r[0]: shingle_set(r[1], 4) for r in rows}
    root = {k: k for k in sets}

    def top(k):
        return k if root[k] == k else top(root[k])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link(docs, words=4).collect()}
    assert got == {k: (len(sets[k]), top(k), top(k) == k) for k in sets}
    assert neardup.link(empty).count() == 0
    assert len({v[1] for v in got.values()}) < len(rows) - 2


def test_neardup_blocks_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = np.random.default_rng(3)
    centres = rng.integers(-(1 << 62), 1 << 62, (3, neardup.FINE // 64))
    fine = {k: centres[k % 3] for k in range(40)}
    component = {k: 0 if k < 18 else k - k % 2 for k in fine}
    size = {k: 100 if k % 7 else 10 for k in fine}
    buckets = {(11, 0): range(40), (12, 3): range(10, 30), (13, 27): range(25, 40)}
    rows = [(b, band, k, component[k], size[k], fine[k].tolist()) for (b, band), ids in buckets.items() for k in ids]
    table = spark.createDataFrame(rows, "bucket long, band int, id long, component long, n long, fine array<long>")
    got = [(r.a, r.b) for r in neardup.in_blocks(table, 80).collect()]
    want = {(a, b) for a in fine for b in fine if a < b and a % 3 == b % 3 and component[a] != component[b] and size[a] == size[b]}
    assert len(got) == len(set(got)) and set(got) == want


def test_substrings_against_dictionary(docs, empty, rows):
    first, want = {}, {}
    data = {r[0]: (r[1] or "").encode() for r in rows}
    for k, b in sorted(data.items()):
        for s in range(len(b) - 49):
            first.setdefault(b[s : s + 50], k)
    for k, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < k:
                gone[s : s + 50] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[k] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.dedup(docs).collect()}
    assert got == want and any(v[1] for v in want.values())
    assert substrings.dedup(empty).count() == 0


def test_two_stage_suffix_array():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        text = np.append(rng.integers(1, 4, n), 0).astype(np.uint8)
        got = substrings.suffix_array(text, depth=400)
        data = text.tobytes()
        assert got.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_suffix_array_of_some_suffixes():
    rng = np.random.default_rng(4)
    for n in (1, 2, 50, 400):
        text = np.append(rng.integers(0, 3, n), 0).astype(np.uint8)
        wanted = rng.random(len(text)) < 0.3
        data = text.tobytes()
        got = substrings.suffix_array(text, depth=500, wanted=wanted).tolist()
        assert sorted(got) == np.flatnonzero(wanted).tolist()
        # what ends is equal to what goes on with zeros
        assert [data[i:].rstrip(b"\0") for i in got] == sorted(data[i:].rstrip(b"\0") for i in got)


def test_substrings_ask_and_answer_by_run(spark):
    """Rows between buckets and chunks follow the runs, not buckets times chunks."""
    run = np.arange(4)
    got = substrings._replies(np.array([7, 7, 3, 7]), run, run, run + 1, kind=2, bucket=5)
    assert got.chunk.tolist() == [3, 7, 7, 7] and got.row.tolist() == [2, 0, 1, 3] and set(got.bucket) == {5} and set(got.kind) == {2}


def test_passages_cover_shared_ones(docs, empty, rows):
    found = passages.near_passages(docs).collect()
    words = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    assert any(r.doc_id == 27 and r.match_doc_id == 26 and r.end - r.start >= 69 for r in found)
    for r in found:
        a, b = shingle_set(" ".join(words[r.doc_id][r.start : r.end]), 5), shingle_set(" ".join(words[r.match_doc_id][r.match_start : r.match_end]), 5)
        assert r.match_doc_id < r.doc_id and r.end - r.start >= 50 and len(a & b) / len(a | b) >= 0.8
    assert passages.near_passages(empty).count() == 0


def test_passages_of_variant_families(spark, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 8)
    rng = random.Random(11)

    def changed(text, n):
        words = text.split()
        for k in rng.sample(range(len(words)), n):
            words[k] = "".join(rng.choice("klmnop") for _ in range(5))
        return " ".join(words)

    table = []
    for _ in range(8):
        first = prose(rng, 90)
        half = first.split()[:45]
        table.append(first)
        for _ in range(4):  # half of each is the first one's, so minima of the family meet the first one
            other = " ".join(half + prose(rng, 55).split())
            table += [changed(other, 1) for _ in range(3)]
    line = "one line that is part of a great many texts without any more in common"
    table += [f"{prose(rng, 40)} {line} {prose(rng, 40)}" for _ in range(30)]
    near = prose(rng, 70)
    table += [f"{near} {line}", f"{line} {changed(near, 1)}", f"{prose(rng, 60)} {line} {changed(near, 1)}"]
    sets = [shingle_set(t, 5) for t in table]
    want = {b for a in range(len(table)) for b in range(a + 1, len(table)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(list(enumerate(table)), "doc_id long, text string").repartition(3)
    found = passages.near_passages(docs).collect()
    assert want <= {r.doc_id for r in found} and {len(table) - 2, len(table) - 1} <= {r.doc_id for r in found}
    words = [t.split() for t in table]
    for r in found:
        a, b = shingle_set(" ".join(words[r.doc_id][r.start : r.end]), 5), shingle_set(" ".join(words[r.match_doc_id][r.match_start : r.match_end]), 5)
        assert r.match_doc_id < r.doc_id and len(a & b) >= 0.8 * len(a | b)


def test_passages_of_each_pair_of_different_documents(spark):
    """A document's passage that is found in one document is looked for in all others of smaller id too."""
    rng = random.Random(23)
    middle = prose(rng, 160).split()

    def changed(places):
        words = list(middle)
        for k in places:
            words[k] = "".join(rng.choice("klmnop") for _ in range(5))
        return " ".join(words)

    # the last is 0.88 like each of the first two, which are 0.77 like each other; the others are alike throughout
    table = [changed([40, 120]), changed([60, 100]), " ".join(middle)] + [changed([80]) for _ in range(3)]
    sets = [shingle_set(t, 5) for t in table]
    want = {(b, a) for a in range(6) for b in range(a + 1, 6) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(list(enumerate(table)), "doc_id long, text string").repartition(2)
    found = passages.near_passages(docs).collect()
    assert (2, 0) in want and (2, 1) in want and len(want) > 5
    assert want <= {(r.doc_id, r.match_doc_id) for r in found}


def test_passages_share_enough_minima():
    n, p = passages.HASHES, passages.PERCENT / 100
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(passages.SHARED)) < 1e-6


def test_compact_windows_are_all_sequences_of_a_minimum():
    value = np.append(np.random.default_rng(1).permutation(40) + 1, 0).astype(np.uint64)
    spans = {(int(c), int(l), int(r)) for c, l, r in zip(*passages.compact_windows(value, 5), strict=True)}
    for i in range(40):
        for j in range(i + 4, 40):
            c = i + int(value[i : j + 1].argmin())
            assert any(w[0] == c and w[1] <= i and j <= w[2] for w in spans)


def test_packing_round_trip(docs, empty, rows):
    plain = Tokenizer.from_file(TOKENIZER)
    ids = {r[0]: [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    pieces = packing.pack(docs, TOKENIZER).collect()
    back, windows = {k: {} for k in ids}, {}
    for p in pieces:
        back[p.doc_id][p.start] = np.frombuffer(p.ids, "<u2").tolist()
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.doc_tokens == len(ids[p.doc_id]) and len(p.ids) == 2 * p.length
    assert {k: sum((v for _, v in sorted(parts.items())), []) for k, parts in back.items()} == ids
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(4096 - sum(n for _, n in s) for s in windows.values()) < 4096
    assert packing.pack(empty, TOKENIZER).count() == 0
    crc = {(r.doc_id, r.start): r.c for r in packing.pack(docs, TOKENIZER).select("doc_id", "start", packing.crc32_of("ids").alias("c")).collect()}
    assert crc[(21, 0)] == zlib.crc32(np.array([2], "<u4").tobytes())


def test_mixing_meets_targets(docs, empty, rows, spark):
    got = mixing.mix(docs).collect()
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    assert {r.doc_id: r.size for r in got} == size
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(size.values())) < 1e-6
    assert all(0 <= r.copies <= 3 and r.target <= 3 * r.source_size for r in got)
    assert sorted(mixing.mix(docs).collect()) == sorted(got)
    assert mixing.mix(empty).count() == 0
    many = spark.range(4000).selectExpr("id doc_id", "repeat('w ', cast(id % 97 as int)) text", "cast(id % 3 as string) source")
    sums = mixing.mix(many).groupBy("source").agg({"target": "first"}).count()
    assert sums == 3
    taken = mixing.mix(many).selectExpr("source", "size * copies t", "target").groupBy("source").agg({"t": "sum", "target": "first"}).collect()
    assert all(abs(r["sum(t)"] - r["first(target)"]) <= 97 for r in taken)


def test_fingerprints_follow_order(docs, empty, rows, spark):
    got = {r.doc_id: r for r in fingerprints.edits(docs).collect()}
    order = sorted((r[:2] for r in rows), reverse=True)
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[doc].n_chars == len(text)
    assert got[0].fingerprint == got[23].fingerprint == got[24].fingerprint
    assert fingerprints.edits(empty).count() == 0
    words = prose(random.Random(9), 400).split()
    moved = words[200:] + words[:200]
    row = spark.createDataFrame([(" ".join(words), " ".join(moved), " ".join(reversed(words)))], "a string, b string, c string")
    near = row.select(*(fingerprints.likeness(fingerprints.sketches(row.a), fingerprints.sketches(row[c])) for c in "abc")).first()
    assert near[0] == 1.0 and near[2] < near[1] < 1.0


def plain_spans(text):
    found = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return found + [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def test_secrets_in_layers():
    key = "AKIA" + "Q7" * 8
    line = f'api_key = "{"x1" * 6}" {"0123abcd" * 5} é {key}!'
    assert {s[:3] for s in secrets.scan_text(line)[0]} >= set(plain_spans(line))
    url = "see " + "".join(f"%{b:02X}" for b in key.encode()) + " end"
    assert [s[:3] for s in secrets.scan_text(url)[0]] == [(4, 4 + 3 * len(key), "access")]
    twice = url.replace("%", "%25")
    assert [s[:3] for s in secrets.scan_text(twice)[0]] == [(4, 4 + 5 * len(key), "access")]
    uni = "a " + "".join(f"\\u{ord(c):04x}" for c in key)
    assert [s[:3] for s in secrets.scan_text(uni)[0]] == [(2, len(uni), "access")]
    b64 = base64.b64encode(f"my words {key} here".encode()).decode()
    (s, e, kind, depth), = [x for x in secrets.scan_text("x " + b64 + " y")[0] if x[2] == "access"]
    assert kind == "access" and depth == 1 and 2 <= s < e <= 2 + len(b64) and key.encode() in base64.b64decode(b64[(s - 2) // 4 * 4 : -(-(e - 2) // 4) * 4])
    packed = base64.b64encode(gzip.compress(base64.b64encode(f"{key} inside of it".encode()))).decode()
    assert [x[:3] for x in secrets.scan_text(packed)[0] if x[2] == "access"] == [(0, len(packed.rstrip("=")), "access")]
    assert secrets.scan_text("%25" * 50 + "%")[0] == []


def test_secrets_in_wrapped_packed_and_binary_layers():
    key = "AKIA" + "Q7" * 8

    def covers(text, start=0, end=None):
        spans = [s for s in secrets.scan_text(text)[0] if s[2] == "access"]
        return any(start <= s[0] < s[1] <= (end or len(text)) for s in spans)

    def wrapped(data, width, end="\n"):
        b64 = base64.b64encode(data).decode()
        return end.join(b64[k : k + width] for k in range(0, len(b64), width))

    plain = f"{'some words ' * 4}x {key} {'and more ' * 9}".encode()
    for width in (20, 64, 76):
        for end in ("\n", "\r\n", "\n    "):
            assert covers(f"Certificate\n{wrapped(plain, width, end)}\nThanks\nBye")
    packed = gzip.compress(bytes(range(256)) * 2 + plain)
    assert covers("x " + wrapped(packed, 64)) and covers("Data\n" + wrapped(packed, 50))
    url = "".join(f"%{b:02X}" for b in packed)
    assert covers(f"see {url} end", 4, 4 + len(url))
    import urllib.parse

    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        assert covers("q=" + urllib.parse.quote_from_bytes(pack(plain)) + "&r=1")
        assert covers("blob = " + repr(pack(plain)))
        two = pack(b"first member of it") + pack(plain)
        assert covers(base64.b64encode(two).decode())
    cut = gzip.compress(plain + random.Random(1).randbytes(4000))
    assert covers(base64.b64encode(cut[:-900]).decode()) and covers(base64.b64encode(cut[:2000] + b"\xff" * 900).decode())
    for code in ("utf-16-le", "utf-16-be", "utf-16"):
        assert covers(base64.b64encode(f"run é {key} now".encode(code)).decode())
    assert covers(base64.b64encode(b"user\0" + key.encode() + b"\0host").decode())
    assert covers(base64.b64encode(b"\xff\xfe\x00\x81" + key.encode() + b"\x90\x01\xfe").decode())


def test_secrets_keep_rows(docs, empty, rows):
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert set(got) == {r[0] for r in rows} and all(r.clean_text == dict((x[0], x[1]) for x in rows)[k] for k, r in got.items())
    assert got[0].spans == "x" and secrets.scan(empty).count() == 0


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((600, 8)).round(3).tolist()
    table = [(k, base[k % 500], k) for k in range(600)] + [(600, None, 0), (601, [0.0] * 8, 0), (602, [float("nan")] * 8, 0), (603, [1.0, None] + [1.0] * 6, 0)]
    vectors = spark.createDataFrame(table, "vec_id long, embedding array<float>, rank int")
    got = forest.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()
    matrix = np.array([np.float32(x) for _, x, _ in table[:600]], np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        score = (matrix @ matrix[q]).round(12)
        best = [k for k in np.lexsort((np.arange(600), -score)) if k != q][:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        hits += len({r.vec_id for r in own} & set(best))
        assert [r.rank for r in own] == [1, 2, 3, 4, 5] and own[0].vec_id == (q + 500 if q < 100 else q - 500 if q >= 500 else best[0])
    assert hits >= 0.9 * 60
    assert forest.nearest(vectors.where("false"), vectors).count() == 0


def test_pages():
    html = '<html><head><title>t</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav><div class="ad">Buy</div>' \
        '<article><h1>Head &amp; tail</h1><p>One  two<br>three<p><b>Four</b> &#233;<div class="comments"><p>No!</div></article><footer>&copy; x</footer>'
    assert [t for t, furniture, root in pages.read(html) if root and not furniture] == ["Head & tail", "One two three", "Four é"]


def page_texts(spark, table):
    frame = spark.createDataFrame(table, "page_id long, url string, html string, text string, host int")
    return [(r.page_id, r.text, r.n_repeated) for r in pages.extract(frame).orderBy("page_id").collect()]


def test_pages_without_mark_lose_what_repeats(spark):
    menu = "<div>start of a long line that all the pages of this host share word for word</div>"
    table = [(k, "http://h.org/%d" % k, f"<body>{menu}<div>{k} is what this page says, {k * 7} things</div></body>", "x", 1) for k in range(3)]
    table += [(3, None, None, None, None), (4, "http://copy.org/a", "<div>told twice on one host and not a word of it gone from either</div>", None, None)]
    table += [(5, "http://copy.org/b", table[4][2], None, None), (5, "http://copy.org/b", table[4][2], None, None), (6, "HTTP://H.org:80/6", "", None, None)]
    said = [(k, f"{k} is what this page says, {k * 7} things", 16) for k in range(3)]
    told = "told twice on one host and not a word of it gone from either"
    assert page_texts(spark, table) == said + [(3, "", 0), (4, told, 0), (5, told, 0), (5, told, 0), (6, "", 0)]
    assert page_texts(spark, []) == []


def test_pages_lose_repeated_blocks_inside_marked_content(spark):
    advert = "<p>Our own neutral words that sell you something</p>"
    table = [(k, f"https://a.org/{k}", f"<main><p>{prose(random.Random(k), 30)}</p>{advert}<p>tail {k}</p></main>", None, None) for k in range(3)]
    # versions of a page agree for the most part: they stay whole
    table += [(9 + k, f"https://b.org/{k}", f"<main><p>{prose(random.Random(77), 40)}</p><p>version {k}</p></main>", None, None) for k in range(2)]
    # quoted on a few of many pages: no boilerplate
    quote = "<p>a passage that some of the pages quote</p>"
    table += [(20 + k, f"https://c.org/{k}", f"<article><p>{prose(random.Random(90 + k), 30)}</p>{quote if k < 4 else ''}</article>", None, None) for k in range(12)]
    got = {k: (text, n) for k, text, n in page_texts(spark, table)}
    for k in range(3):
        assert got[k] == (prose(random.Random(k), 30) + f"\n\ntail {k}", 8)
    for k in range(2):
        assert got[9 + k] == (prose(random.Random(77), 40) + f"\n\nversion {k}", 0)
    assert all(n == 0 and ("that some" in text) == (k < 24) for k, (text, n) in got.items() if k >= 20)


def test_pages_names_are_whole():
    assert pages.content('<div class="page no-sidebar"><article><p>a<p class="cookie-recipe">b<p class="site-notice">c</article></div>') == (["a", "b"], [True, True])
    assert pages.content('<div class="widget"><article><p>a</article></div><p>b')[0] == ["a", "b"]
    assert pages.content('<div class="related-posts"><article>teaser</article></div><article>a</article>')[0] == ["a"]
    assert pages.content('<form><main>a<form>b</form></main></form>')[0] == ["a"]
    assert pages.content('<aside><article>a</article></aside>')[0] == [] == pages.content(None)[0]


def test_pages_against_all_substrings(spark):
    """Runs outside marked content against a plain look at all substrings of all pages of the host."""
    rng = random.Random(12)
    common = [prose(rng, n).split() for n in (9, 14, 20, 40)]
    streams = []
    for k in range(12):
        words = []
        for _ in range(6):
            words += prose(rng, rng.randint(1, 12)).split()
            words += rng.choice(common) if rng.random() < 0.6 else []
        streams.append(words)
    table = [(k, "http://x.org", "<p>" + " ".join(w) + "</p>", None, None) for k, w in enumerate(streams)]
    got = page_texts(spark, table)
    for k, words in enumerate(streams):
        gone = [False] * len(words)
        for i in range(len(words) - pages.REPEAT + 1):
            part = words[i : i + pages.REPEAT]
            n = sum(any(o[j : j + pages.REPEAT] == part for j in range(len(o))) for o in streams)
            if n > 1 and n >= pages.RUN_SHARE * len(streams):
                gone[i : i + pages.REPEAT] = [True] * pages.REPEAT
        keep, at = [], 0
        for piece in re.findall(r"x+|\.+", "".join("x" if g else "." for g in gone)):
            if piece[0] == "." or len(piece) < pages.LONG:
                keep += words[at : at + len(piece)]
            at += len(piece)
        assert got[k] == (k, " ".join(keep), len(words) - len(keep))
    assert any(n for _, _, n in got)


def test_language(docs, empty, spark):
    rng = random.Random(4)
    table = [(k, prose(rng, 60, "abcde" if k % 2 else "vwxyz"), "one" if k % 2 else "two") for k in range(60)] + [(60, None, "one"), (61, "12 !!", None)]
    table = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = language.fit(table)
    got = {r.doc_id: r for r in language.identify(table, model).collect()}
    assert all(got[k].lang_pred == ("one" if k % 2 else "two") and got[k].score > 0.99 and not got[k].rejected for k in range(60))
    assert got[60].lang_pred == got[61].lang_pred == "und" and got[60].rejected and got[61].score == 0
    odd = spark.createDataFrame([(1, "qqq www ppp lll mmm nnn ooo " * 5)], "doc_id long, text string")
    assert language.identify(odd, model).first().rejected
    assert {r.lang_pred for r in language.identify(docs, language.fit(empty)).collect()} == {"und"}
    # a small language beside a large one of many grams, and labels whose texts have no letter
    mixed = spark.createDataFrame([(k, prose(rng, 400), "large") for k in range(60)] + [(90 + k, "xyx zzy yxz", "small") for k in range(3)] + [(99, "12 34", "digits")], "doc_id long, text string, lang string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language, "MIN_SHARE", 1e-3)
        cut = language.fit(mixed)
    assert cut.langs == ["large", "small"] and len(cut.grams[3]) < 2000
    got = {r.doc_id: r.lang_pred for r in language.identify(mixed, cut).collect()}
    assert all(got[k] == ("large" if k < 60 else "small") for k in got if k != 99) and got[99] == "und"
    # probabilities after any context sum to at most one
    top = model.grams[1] >> 8
    for context in np.unique(top)[:20]:
        assert (np.exp(model.logs[1][top == context]).sum(axis=0) <= 1.0001).all()


def plain_kneser_ney(texts, text):
    """Cross-entropy per character by dictionaries, recursively; texts of lower-case letters and single spaces."""
    def runs(t):
        return "\n\n\n" + t + "\n"

    seen = Counter(runs(t).replace(" ", "\n")[i : i + 4] for t in texts for i in range(len(t) + 1))
    levels = [seen]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def p(gram):
        if not gram:
            return 1 / 256
        level, context = levels[len(gram) - 1], gram[:-1]
        total = sum(n for g, n in level.items() if g[:-1] == context)
        if not total:
            return p(gram[1:])
        kinds = sum(g[:-1] == context for g in level)
        return max(level[gram] - language.DISCOUNT, 0) / total + language.DISCOUNT * kinds / total * p(gram[1:])

    whole = runs(text).replace(" ", "\n")
    grams = [whole[i : i + 4] for i in range(len(text) + 1)]
    return -sum(math.log(p(g)) for g in grams) / len(grams)


def test_language_against_plain_kneser_ney(spark):
    rng = random.Random(8)
    texts = [prose(rng, 12, "abcd") for _ in range(6)]
    model = language.fit(spark.createDataFrame([(t, "one") for t in texts], "text string, lang string"))
    for text in [texts[0], prose(rng, 9, "abcd"), prose(rng, 9, "cdef"), "a"]:
        assert abs(language.entropies(model, [text])[0][0, 0] - plain_kneser_ney(texts, text)) < 1e-4


def test_pipeline_near_duplicates_by_row(spark):
    import corpus_pipeline

    rng = random.Random(2)
    texts = [prose(rng, 60) for _ in range(4)]
    data = [(5, texts[0]), (None, texts[0]), (2, texts[0]), (7, texts[1]), (7, texts[2]), (7, texts[2]), (None, texts[3]), (None, None), (1, ""), (1, "")]
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.neardup_stage(spark, docs, "").collect()
    want = [(2, texts[0]), (7, texts[1]), (7, texts[2]), (None, texts[3]), (None, None), (1, ""), (1, "")]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)


def test_fingerprints_of_repeated_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "x"), (None, None), (None, None), (None, None)]
    got = fingerprints.edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == [("1", 7), ("1", 7), ("2", 1), ("None", 0), ("None", 0), ("None", 0)]


def test_known_words_are_found_by_their_slots(monkeypatch):
    texts, plain = ["one two three don't stop", "two two stöp \x01 one", ""], Tokenizer.from_file(TOKENIZER)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    words = packing.WordTokenizer(TOKENIZER)
    assert [x.tolist() for x in words.encode(texts)] == want
    known, words.hashes, words.number = words.starts.size, words.hashes[:0], words.number[:0]
    assert [x.tolist() for x in words.encode(texts)] == want and words.starts.size == known
    monkeypatch.setattr(packing, "SLOT_BITS", 1)  # most words find their slot taken
    words = packing.WordTokenizer(TOKENIZER)
    assert [[x.tolist() for x in words.encode(texts)] for _ in range(2)] == [want, want]


def test_word_tokenizer_against_whole_texts(rows):
    words = packing.WordTokenizer(TOKENIZER)
    texts = [t or "" for _, t, *_ in rows] + ["a\x01b \x01", "\x01", " lead", "trail \n", "a\tb\x0bc d"]
    want = [words._ids(t) for t in texts]
    assert [x.tolist() for x in words.encode(texts)] == want and words.encode([]) == []
    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("PIECE", 9), ("MEMORY", 5), ("BATCH", 2)):
            patch.setattr(packing, name, value)
        assert [x.tolist() for x in words.encode(texts)] == want
    # all words of one length have one hash
    words.code[:] = words.power[:1] = words.back[:1] = 1
    words.base, words.inverse, words.power, words.back = np.uint64(1), np.uint64(1), words.power[:1], words.back[:1]
    words.clear()
    assert [x.tolist() for x in words.encode(texts)] == want


def test_pipeline_stages(spark, rows, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = tmp_path / name.replace(" ", "_")
        stage(spark, docs, str(tmp_path)).write.parquet(str(out))
        docs = spark.read.parquet(str(out))
        seen.append((name, docs.count(), docs.columns))
    assert [s[2] for s in seen[:4]] == [corpus_pipeline.COLUMNS] * 4
    assert seen[0][1] == len(rows) - 3 and seen[1][1] < seen[0][1] and seen[2][1] == seen[1][1]


def test_language_levels_come_from_every_text(spark):
    """All documents of a language fix its mean and deviation, however many there are."""
    texts = ["the quick brown fox jumps over the lazy dog again and again " * (1 + k % 7) + "zqx" * (k % 11) for k in range(1500)]
    model = language.fit(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"))
    own = language.entropies(model, texts)[0][:, 0]
    assert abs(model.mean[0] - own.mean()) < 1e-9


def test_texts_stay_where_counts_are_joined(spark, docs, rows):
    """Counts per task travel to texts and ids: no join of packing or mixing sorts them anew, whatever Spark guesses of sizes."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (packing.pack(docs, TOKENIZER), common.numbered(docs.select("doc_id", "text"), [docs.doc_id], "some")):
            joins = re.findall(r"\w+Join", frame._jdf.queryExecution().sparkPlan().toString())
            assert joins[0] == "BroadcastHashJoin" and joins.count("SortMergeJoin") <= 1  # counts of tasks with each other
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packing_numbers_whole_windows_of_a_task(spark):
    """Whole windows follow each other without a gap, by task, length and turn."""
    lengths = [4096 * (k % 3) + 64 * (k * 7 % 5) + k % 11 for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join(["a"] * max(0, n - 1))) for k, n in enumerate(lengths)], "doc_id long, text string").repartition(3).cache()
    pieces = packing.pack(docs, TOKENIZER).collect()
    whole = sorted(p.sequence_id for p in pieces if p.length == packing.WINDOW)
    ids = {p.doc_id: p.doc_tokens for p in pieces}
    full = sum(n // packing.WINDOW for n in ids.values())
    assert full > 30 and len(set(whole)) == len(whole) >= full
    assert whole[:full] == list(range(whole[0], whole[0] + full))
    assert sum(p.length for p in pieces) == sum(ids.values())


def test_pages_lose_repeated_runs_inside_marked_content(spark):
    """A long run on most pages of a host goes from marked content too, within a block or over several; on fewer pages it stays."""
    notice = "we use neutral words here to tell all the readers of this site that it is sold by weight and never by the yard"
    table, want = [], {}
    for k in range(6):
        own, more = prose(random.Random(40 + k), 40), prose(random.Random(60 + k), 5)
        quote = prose(random.Random(3), 20) if k < 2 else ""
        table.append((k, f"https://d.org/{k}", f"<body><main><p>{own}</p><p>{more} {notice}</p><p>{k} tail {quote}</p></main></body>", None, None))
        want[k] = ("\n\n".join([own, more, f"{k} tail {quote}".strip()]), len(notice.split()))
    # a host with a page that marks nothing: a run on a quarter of its pages goes from that page only
    run = prose(random.Random(8), 20)
    for k in range(10, 18):
        own = prose(random.Random(40 + k), 30)
        table.append((k, f"https://e.org/{k}", f"<{'div' if k == 10 else 'main'}><p>{own} {run if k < 13 else ''}</p></{'div' if k == 10 else 'main'}>", None, None))
        want[k] = (own, 20) if k == 10 else (f"{own} {run if k < 13 else ''}".strip(), 0)
    assert {k: (text, n) for k, text, n in page_texts(spark, table)} == want
