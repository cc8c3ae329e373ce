"""Every operator against a plain version on small fixtures: nulls, empty and long texts, ties, repeats, clashing names."""

import base64
import collections
import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, common, decontaminate, extract, language, ngram_join, quality_classifier, quality_rules, sharding, text_stats, token_files, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_words bigint, node string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def frame(spark, rows, ddl=DOCS):
    return spark.createDataFrame(rows, ddl)


def words(draw, n):
    return " ".join("".join(draw.choice(LETTERS[:12]) for _ in range(draw.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """(doc_id, text): null, empty, blank, one word, repeated row, null id, letters outside ASCII, a long text."""
    draw = random.Random(5)
    base = words(draw, 60)
    texts = [None, "", " \n\t ", "Ünique", base, base.upper() + " x", "ÇÉ " + base + " 日本語 🙂", words(draw, 9000), "a\nb\na\n\n a", "!!! ### $$$ " * 40, base + "\n" + base]
    rows = list(enumerate(texts)) + [(4, base), (None, base), (None, None), (77, base)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    """With columns whose names the operators use for their own results."""
    return frame(spark, [(i, t, None if k % 5 == 0 else "en", f"s{k % 2}", 7, "x") for k, (i, t) in enumerate(odd_rows)]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# --- 1 -----------------------------------------------------------------------------------------------------

PATTERN_1 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_decontaminate(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = PATTERN_1.findall(fold(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = PATTERN_1.findall(fold(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_decontamination(spark, odd_rows, broadcast_rows):
    draw = random.Random(1)
    items = [(i, words(draw, draw.randint(8, 40))) for i in range(12)] + [(20, "Zwei Wörter"), (21, "solo"), (22, None), (23, "..."), (24, ""), (None, words(draw, 30))]
    items += [(30, items[0][1]), (0, items[0][1])]  # the same text under another id, and a repeated row
    docs = list(odd_rows)
    for k, (_, text) in enumerate(items):
        w = (text or "").split()
        docs.append((100 + k, words(draw, 20) + " " + " ".join(w[2:14]).upper().replace(" ", "-- ") + " " + words(draw, 5)))
        docs.append((200 + k, " ".join(w[:9]) + " " + words(draw, 3)))  # one word short of a window
        docs.append((300 + k, (text or "") + " " + (text or "")))
    got = decontaminate.digest(decontaminate.decontaminate(frame(spark, docs, "doc_id bigint, text string"), frame(spark, items, "item_id bigint, text string"), broadcast_rows=broadcast_rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_decontaminate(docs, items)


def test_decontamination_of_nothing(spark, odd, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.digest(decontaminate.decontaminate(odd, none)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty, none).count() == 0
    assert decontaminate.clean(odd, none).count() == odd.count()


def test_clean_drops_whole_documents_and_keeps_columns(spark, odd, odd_rows):
    items = frame(spark, [(1, odd_rows[4][1])], "item_id bigint, text string")
    kept = decontaminate.clean(odd, items)
    assert kept.columns == odd.columns
    want = [r for r in odd_rows if odd_rows[4][1] not in fold(r[1])]
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted((r for r in want if r[0] is not None), key=str) or kept.count() == len(want)


# --- 2 -----------------------------------------------------------------------------------------------------

def test_gradients_match_differences():
    net = language.Network(["a", "b", "c"], hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    draw = np.random.default_rng(0)
    x, y = draw.integers(0, 257, (7, 5)).astype(np.int16), draw.integers(0, 3, 5)
    _, grads = net.gradients(x, y)
    for name in net.weights:
        flat = net.weights[name].reshape(-1)
        at = np.argmax(np.abs(grads[name].reshape(-1)))
        was = flat[at]
        flat[at] = was + 1e-2
        up = net.gradients(x, y)[0]
        flat[at] = was - 1e-2
        down = net.gradients(x, y)[0]
        flat[at] = was
        assert abs((up - down) / 2e-2 - grads[name].reshape(-1)[at]) < 2e-3, name


def test_language(spark, empty):
    draw = random.Random(3)
    alphabet = {"xx": "abcdefgh", "yy": "opqrstuv", "zz": "éàüöß"}
    rows = [(i, " ".join("".join(draw.choice(alphabet[lang]) for _ in range(5)) for _ in range(40)), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(alphabet), 240))]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "123 !!! 456", "zz"), (903, "ABCDEFGH HGFEDCBA", None), (None, "opqrs tuvop", "xx")]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string")
    net = language.train(docs, epochs=4)
    out = {r.doc_id: r for r in language.identify(docs.withColumn("held", language.held_out(F.col("doc_id"))), net).collect()}
    held = [i for i, _, _ in rows[:240] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(out[i].held for i in held) and sum(r.held for r in out.values()) == len(held) + sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(900, 904))
    assert sum(out[i].lang_pred == out[i].lang for i in held) >= 0.95 * len(held)
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902))
    assert out[903].lang_pred == "xx" and out[None].lang_pred == "yy" and all(0 <= r.score <= 1 for r in out.values())
    assert language.train(empty) is None
    assert language.identify(docs.select("doc_id", "text"), None).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty.select("doc_id", "text"), net).count() == 0


def test_every_byte_counts():
    net = language.Network(["a", "b"])
    text = "abc é" * 500
    p = net.documents([text, "", "x"])
    raw = np.frombuffer(text.encode(), np.uint8)
    padded = np.full(-(-len(raw) // language.WINDOW) * language.WINDOW, language.PAD, np.int16)
    padded[:len(raw)] = raw
    each = net.probabilities(padded.reshape(-1, language.WINDOW).T.copy())
    assert np.allclose(each.transpose(1, 0, 2).reshape(-1, 2)[:len(raw)].mean(axis=0), p[0], atol=1e-5)
    assert p[1].sum() == 0 and abs(p[2].sum() - 1) < 1e-5


# --- 3 and 5 -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


STRANGE = ["", " ", "  a", "a  b ", "a\n b", "a \nb", "x\n", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "don't we'll 'tis", "a  b", "x\x1c y", "日本 語🙂 ﷺ",
           "a" * 3000, "=-" * 300, "0123456789 " * 50, "\x00 \x01", "tab\tsep \t x", "é ​ z"]


def strange(n=400):
    draw = random.Random(8)
    yield from STRANGE
    for _ in range(n):
        yield "".join(draw.choice("abcdehnorst  -.,'\né中") for _ in range(draw.randint(1, 60)))
        yield "".join(chr(draw.choice([draw.randint(1, 0x2FFF), draw.randint(0x20, 0x7E)])) for _ in range(draw.randint(1, 30)))


def test_encoder_equals_the_library(library):
    vocab, cached = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")), token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in strange():
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(vocab.encode(text), "<u4")
        assert got.tolist() == want, text
        assert np.frombuffer(cached.encode(text), "<u4").tolist() == want, text
        assert vocab.decode_text(got.astype(np.int64)) == library.decode(want, skip_special_tokens=False)


def test_every_character_is_split_as_by_the_library(library):
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocab, cached = bpe.Vocabulary(path), token_files.Encoder(path)
    points = [c for c in (*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x20000), *range(0x20000, 0x323B0, 16), *range(0x323B0, 0x33480, 4)) if not 0xD800 <= c < 0xE000]
    texts = [f"{chr(c)}'s x" for c in (0x558, 0x88F, 0xC5C, 0x208F, 0xA7CE, 0x10940, 0x323B0, 0x33479)]
    texts += [" ".join(f"{chr(c)}'s x" for c in points[k:k + 500]) for k in range(0, len(points), 500)]
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        packed = np.array(want.ids, "<u4").tobytes()
        assert vocab.encode(text) == packed and cached.encode(text) == packed, (text[:1], len(text))


def test_decoder_replaces_broken_characters(library):
    vocab, draw = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    for _ in range(300):
        ids = [draw.randint(0, 50256) for _ in range(6)]
        assert vocab.decode_text(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_full_caches_change_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    vocab = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    text = "one two three four five six one two seven"
    assert np.frombuffer(vocab.encode(text), "<u4").tolist() == library.encode(text).ids


def test_round_trip(odd, odd_rows, empty, library):
    got = bpe.round_trip(odd.select("doc_id", "text")).collect()
    want = []
    for doc, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, text, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(empty.select("doc_id", "text")).count() == 0
    there = bpe.decode(bpe.encode(odd.select("doc_id", "text"))).collect()
    assert all(r.decoded == (r.text or "") for r in there)


@pytest.mark.parametrize("file_bytes", [2000, 1 << 27])
def test_token_files(spark, odd, odd_rows, library, file_bytes):
    manifest = token_files.write_token_files(odd, file_bytes=file_bytes)
    got = [tuple(r) for r in token_files.read_digests(manifest, read_docs=3).orderBy("start").collect()]
    at, want = 0, []
    for doc, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        want.append((doc, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert [g[1] for g in got] == list(itertools.accumulate([0, *(g[2] for g in got[:-1])])) and got[-1][1] + got[-1][2] == at
    assert [g[0] for g in got] == [w[0] for w in want] and sorted((g[0] or -1, g[2], g[3]) for g in got) == sorted((w[0] or -1, *w[1:]) for w in want)
    row = manifest.orderBy(F.desc("part")).first()
    found = token_files.read_documents(row.file, [77, 12345])
    assert list(found) == [77] and found[77].tolist() == [*library.encode(odd_rows[-1][1], add_special_tokens=False).ids, 0]
    data = common_read(row.file)
    assert struct.unpack("<I", data[-4:])[0] == token_files.SEEKABLE
    # Any reader of zstandard frames gets the ids; skippable frames are passed over.
    assert len(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()) == 4 * row.tokens


def common_read(uri):
    from tidemark.llm.storage import open_ranges
    file = open_ranges(uri)
    return file.read_at(file.size(), 0)


def test_damaged_frames_are_found(spark, odd, tmp_path):
    row = token_files.write_token_files(odd.where("doc_id = 7")).first()
    data = bytearray(common_read(row.file))
    data[len(data) // 4] ^= 0x55
    (tmp_path / "x.zst").write_bytes(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.read_documents(f"file://{tmp_path}/x.zst", [7])


def test_token_files_of_nothing(empty):
    manifest = token_files.write_token_files(empty)
    assert manifest.count() == 0 and token_files.read_token_files(manifest).count() == 0


# --- 4 -----------------------------------------------------------------------------------------------------

PAGES = [(5, "http://WWW.b.example.com:80/p?q=1#f", "<p>one</p>"), (3, "https://b.example.com/z", "<p>one</p>"), (9, "https://a.example.org", "<p>one</p>"), (1, None, None), (2, "not a url", ""),
         (4, "http://x.example.com/é ü", "ü\r\n\r\nWARC/1.1"), (4, "http://x.example.com/é ü", "ü\r\n\r\nWARC/1.1"), (None, "http://x.example.com/", "<p>two</p>"), (6, "http://[bad", "<p>two</p>"),
         (None, "http://x.example.com/", "alone"), (8, "http://long.example.com/", "x" * 300_000)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "?", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, n int")
    index = warc.build_index(warc.write_archives(pages), block_lines=2, part_lines=4)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(index, span_bytes=500).collect()), key=str)
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        to = first.get(html or "")
        revisit = to is not None and to != page
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    assert got == sorted(want, key=str)
    bodies = {r.page_id: r.payload for r in warc.read_archives(index).where("record_type = 'response'").collect()}
    assert bytes(bodies[4]).decode() == PAGES[5][2] and len(bodies[8]) == 300_000

    rows = [r.asDict() for r in index.orderBy("part").collect()]
    assert len(rows) > 1 and rows == sorted(rows, key=lambda r: r["first_key"])
    assert [r["page_id"] for r in warc.lookup(rows, "http://www.b.example.com/p?q=1")] == [5]
    assert sorted(str(r["page_id"]) for r in warc.lookup(rows, "http://x.example.com/")) == ["None", "None"]
    assert len(warc.lookup(rows, "http://x.example.com/é ü")) == 2 and warc.lookup(rows, "http://nowhere.example.com/") == []


def test_warc_of_nothing(spark):
    index = warc.build_index(warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string")))
    assert index.count() == 0 and warc.read_archives(index).count() == 0 and warc.lookup([], "http://a/") == []


def test_short_payloads_may_be_stored_each_time(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x")], "page_id bigint, url string, html string")
    assert warc.write_archives(pages, min_revisit_bytes=2).where("record_type = 'revisit'").count() == 0


# --- 6 -----------------------------------------------------------------------------------------------------

def page(title, *paragraphs, extra=""):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p><p>no';</script></head><body><nav><ul><li><a>Home</a></li><li>About</li></ul></nav><!-- <p>no</p> -->"
            f"<div class=\"ad\">Buy</div><article><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}{extra}</article><div id='comments'><p>First!</p></div><footer>&copy; us</footer></body></html>")


def test_extraction(spark):
    cases = [
        (1, "http://h.example.com/1", page("A &amp; B", "one  two\n three", "f&uuml;r <b>b</b>old&nbsp;x"), "A & B\none two three\nfür bold x"),
        (2, "http://h.example.com/2", page("C", "p", extra="<aside>rel</aside><form><p>mail</p></form><ul><li>x<li>y</ul>"), "C\np\nx\ny"),
        (3, "http://h.example.com/3", page("D", *[f"par {k}" for k in range(50)]), "D\n" + "\n".join(f"par {k}" for k in range(50))),
        (4, "http://alone.example.com/", "<p><b>Open<br><p>Anha<p>", "Open\nAnha"),
        (5, None, None, ""), (6, "http://h.example.com/4", "", ""), (7, "http://h.example.com/5", "<html><body><nav>x</nav>", ""),
        (8, "http://h.example.com/6", page("E", "p < q", "<p unclosed"), None),
        (9, "http://div.example.com/1", "<body><div class=top>Site</div><div class=inner><p>Long text of the first page here</p><p>more</p></div><div class=sidebar>s</div></body>", None),
        (1, "http://h.example.com/1", page("A &amp; B", "one  two\n three", "f&uuml;r <b>b</b>old&nbsp;x"), "A & B\none two three\nfür bold x"),
    ]
    pages = spark.createDataFrame([(*c[:3], "x") for c in cases], "page_id bigint, url string, html string, text string")
    for limit in (1, 200):
        got = {r.page_id: r for r in extract.extract(pages, shapes_per_task=limit).collect()}
        for number, url, _, want in cases:
            assert got[number].url == url and got[number].n_chars == len(got[number].text)
            if want is not None:
                assert got[number].text == want
        assert "Long text of the first page here\nmore" in got[9].text and "\ns" not in got[9].text
    assert extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("depth", [150, 199, 200, 201, 260, 5000])
def test_deep_nesting_loses_nothing_and_lets_nothing_in(depth):
    deep = "<div>" * depth + "<p>inner</p><div class=advert><div><p>Buy</p></div></div>tail" + "<section>one</section>two" + "</div>" * depth
    page = f"<body><div id=x><article><h1>Title</h1><p>before</p>{deep}<p>after</p></article></div><footer>us</footer></body>"
    assert extract.main_text(page, None).split("\n") == ["Title", "before", "inner", "tail", "one", "two", "after"]


def test_slash_of_an_unquoted_value_closes_nothing():
    top = extract.parse("<article><section data-u=/a/><p>in</p></section><p>out</p><div hidden/><div class='a'/><div /><p>end</p></article>")
    article = top.children[0]
    assert [c.sig for c in article.children] == ["section", "p", "div", "div class=a", "div", "p"] and len(article.children[0].children) == 1


def test_template_without_names_is_told_by_its_constancy(spark):
    rows = [(k, f"http://plain.example.com/{k}", f"<body><div>Our site</div><div><h2>Title {k}</h2><p>Body text number {k} that differs</p></div><div>Imprint and so on</div></body>") for k in range(6)]
    got = extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r.text == f"Title {r.page_id}\nBody text number {r.page_id} that differs" for r in got)


def test_text_of_few_pages_is_no_template(spark):
    def plain(k, extra=""):
        return f"<body><div>Our site</div><div><h2>Title {k}</h2><p>Body text number {k} that differs</p>{extra}</div><div>Imprint and so on</div></body>"

    extras = {1: ("<blockquote>Said once</blockquote>", "Said once"), 4: ("<h3>Alone</h3>", "Alone"), 5: ("<table><tr><td>cell</table>", "cell"), 7: ("<ul><li>item</ul>", "item")}
    rows = [(k, f"http://plain.example.com/{k}", plain(k, extras.get(k, ("",))[0])) for k in range(9)]
    copies = [(100 + k, "http://copies.example.com/x", plain(1)) for k in range(4)]
    named = [(200 + k, "http://named.example.com/x", "<body><div>Site</div><div class=content><p>One paragraph of text</p></div></body>") for k in range(4)]
    # Many copies of one page make nothing of it a template of the others.
    mixed = [(300 + k, "http://mixed.example.com/x", plain(min(k, 3))) for k in range(20)]
    pages = spark.createDataFrame(rows + copies + named + mixed, "page_id bigint, url string, html string")
    for limit in (1, 200):
        got = {r.page_id: r.text for r in extract.extract(pages, shapes_per_task=limit).collect()}
        for k in range(9):
            assert got[k] == "\n".join([f"Title {k}", f"Body text number {k} that differs", *extras.get(k, ())[1:]])
        assert all("Title 1\nBody text number 1 that differs" in got[100 + k] for k in range(4))
        assert all(got[200 + k] == "One paragraph of text" for k in range(4))
        assert all(got[300 + k] == f"Title {min(k, 3)}\nBody text number {min(k, 3)} that differs" for k in range(20))


def test_alignment_finds_repetitions_and_options():
    trees = [extract.tree_of(shape, [(h or None, n) for h, n in slots]) for shape, slots in (extract.shape_of(h) for h in (
        "<body><h1>a</h1><ul><li>1<li>2</ul><p>x", "<body><h1>b</h1><p>y<p>z", "<body><h1>c</h1><dl><dt>k<dd>v<dt>k<dd>w</dl><p>y"))]
    whole = extract.align(extract.align(trees[0], trees[1]), trees[2])
    text = whole.expression()
    assert "(<ul>(<li>#</>)+</>)?" in text and "(<p>#</>)+" in text and "(<dl>(<dt>" in text and "+</>)?" in text


# --- 7 -----------------------------------------------------------------------------------------------------

def plain_groups(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), doc if not sets[i] else least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def near_copies(odd_rows):
    """Chains of ever more edited copies, a large group, a passage that many share, and sets at the threshold."""
    draw, rows = random.Random(4), [(i, t) for i, t in odd_rows if i is not None and i != 4] + [(4, odd_rows[4][1])]
    passage = words(draw, 60)
    for g in range(12):
        w = words(draw, draw.choice([6, 20, 90, 300])).split()
        for k in range(draw.choice([1, 2, 6, 25])):
            rows.append((1000 * (g + 1) + k, " ".join(w)))
            for _ in range(max(1, len(w) // 40)):
                w[draw.randrange(len(w))] = words(draw, 1)
    rows += [(50_000 + k, words(draw, 60) + " " + passage + " " + words(draw, 30)) for k in range(40)]
    w = [f"w{k}" for k in range(39)]  # 35 shingles; cutting words off the end meets the threshold exactly or misses it
    rows += [(60_000 + k, " ".join(w[:39 - k])) for k in range(0, 14)] + [(61_000, " ".join(["y", *w[:28]]))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [2000, 4])
def test_similar_groups(spark, near_copies, piece):
    docs = frame(spark, [(i, t, "x", 1, 2) for i, t in near_copies], "doc_id bigint, text string, node string, n int, block int")
    got = ngram_join.similar_groups(docs, piece=piece, sample_docs=60).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(near_copies)


@pytest.mark.parametrize("sample_docs", [1, 10_000])
def test_any_sample_of_common_shingles_gives_the_same_groups(spark, near_copies, sample_docs):
    docs = frame(spark, near_copies, "doc_id bigint, text string")
    got = ngram_join.similar_groups(docs, sample_docs=sample_docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(near_copies)


def test_large_blocks_of_chance_links_are_cut_again(spark, monkeypatch):
    """Short texts that share a passage here and there make a large block, but its sets don't all meet each other."""
    draw, calls = random.Random(41), collections.Counter()
    passages = [words(draw, 5) for _ in range(60)]
    rows = [(i, " ".join(words(draw, 9) + " " + passages[draw.randrange(60)] for _ in range(3))) for i in range(300)]
    rows += [(1_000 + i, rows[i][1] + " end") for i in range(8)]
    for name in ("_blocks_again", "_large_block_links"):
        monkeypatch.setattr(ngram_join, name, lambda *a, _name=name, _f=getattr(ngram_join, name): (calls.update([_name]), _f(*a))[1])
    got = ngram_join.similar_groups(frame(spark, rows, "doc_id bigint, text string"), piece=20).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(rows)
    assert calls == {"_blocks_again": 1}


def test_groups_with_null_and_repeated_ids(spark, odd, odd_rows, empty):
    got = ngram_join.similar_groups(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_groups(odd_rows)
    assert ngram_join.similar_groups(empty).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and 77 not in {r.doc_id for r in kept.collect()}


def test_keep_one_with_repeated_clashing_and_null_ids(spark):
    """One row of each group stays, and no text is lost because its id stands on another row too."""
    draw = random.Random(31)
    a, b, c, d = (words(draw, 60) for _ in range(4))
    rows = [(1, a), (1, a), (None, a), (5, a), (5, b), (5, b + " more"), (None, c), (None, c), (7, d), (8, d), (9, None), (9, ""), (9, None), (None, None)]
    docs = frame(spark, [(i, t, "en", f"s{k}", k, "x") for k, (i, t) in enumerate(rows)])
    kept = collections.Counter((r.doc_id, r.text) for r in ngram_join.keep_one(docs).collect())
    same_group = plain_groups([(0, b), (1, b + " more")])[1][2] == 0
    want = collections.Counter([(1, a), (None, c), (7, d), (9, None), (9, None), (9, ""), (None, None)])
    pair = [t for i, t in kept if i == 5]
    assert len(pair) == (1 if same_group else 2) and set(pair) <= {b, b + " more"}
    assert kept - collections.Counter({(5, t): 1 for t in pair}) == want


def test_chunks_encoded_together_equal_the_library():
    cached, draw = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    odd = ["", "a", " a", "a ", "a  b", "x\n y", "foo\n\n", "\n", "q \nfoo", "don't 's x", "日本 語 　a", "<|endoftext|> a b", "a\tb c\t", "tail\n", "\nhead next", "e f g", "ſ 's ſx", words(draw, 300)]
    for _ in range(60):
        texts = [draw.choice(odd) + draw.choice(["", " ", "\n"]) + draw.choice(odd) for _ in range(draw.randint(1, 9))]
        assert cached.encode_all(texts) == [cached.whole(t) if t else b"" for t in texts]


def test_a_run_of_texts_costs_few_calls_of_the_library(monkeypatch):
    """Each distinct chunk is encoded once per run of texts, many in one call; no chunk is kept afterwards."""
    cached, draw = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(5)
    monkeypatch.setattr(token_files, "JOINED_CHUNKS", 7)
    texts = [words(draw, 200) + draw.choice(["", "\x1c x", " \u3000y", "\x1fz z\x1e end", " Ġa"]) for _ in range(20)]
    assert cached.encode_all(texts) == [cached.whole(t) for t in texts]
    assert len(cached._chunks) < 100


def test_batches_of_a_task_are_encoded_together(spark, library):
    draw = random.Random(6)
    rows = [(i, None if i % 400 == 0 else words(draw, 3)) for i in range(2_500)]
    frames = token_files.token_frames(frame(spark, rows, "doc_id bigint, text string").coalesce(1), public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in frames.collect()} == {i: 1 + len(library.encode(t or "").ids) for i, t in rows}


def test_tree_rules_out_no_similar_pair():
    draw = np.random.default_rng(6)
    sets = []
    for size in (1, 2, 3, 40, 44, 400, 3000):
        base = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
        for _ in range(30):
            keep = base[draw.random(len(base)) > draw.choice([0, 0.05, 0.2])]
            own = np.unique(np.concatenate([keep, draw.integers(0, 1 << 63, draw.integers(0, 1 + size // 8), dtype=np.uint64)]))
            if len(own):
                sets.append(own)
    tree = ngram_join.SignatureTree(sets)
    found = {(int(x), int(y)) for a, b in tree.candidates() for x, y in zip(a, b, strict=True)}
    similar = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if ngram_join._similar(tree.sets[i], tree.sets[j])}
    assert similar and similar <= found and len(found) < len(sets) ** 2 / 4


def test_a_written_table_leaves_no_shuffle_files(spark):
    def kept():
        return {str(k) for k in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if k.startswith("shuffle_")}

    before, setting = kept(), spark.conf.get(common._FILE_CLEANUP, None)
    rows = common.written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n")), "sums")
    assert sorted(map(tuple, rows.collect())) == [(k, 100) for k in range(10)]
    assert not kept() - before and spark.conf.get(common._FILE_CLEANUP, None) == setting


def test_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000 + k) for k in range(1, 50)]
    parent = {n: n for e in edges for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in common.components(frame(spark, edges, "a bigint, b bigint")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


@pytest.mark.parametrize("edge_rows", [20, 100_000])
def test_components_take_rounds_only_beyond_one_task(spark, monkeypatch, edge_rows):
    """Each round costs the driver a plan with joins."""
    tables, write = [], common.written
    monkeypatch.setattr(common, "EDGE_ROWS", edge_rows)
    monkeypatch.setattr(common, "written", lambda df, name: tables.append(name) or write(df, name))
    edges = [(k, k + 1) for k in range(-100, 100)] + [(500, 501), (7, 7), (None, 3), (501, 500)]
    got = {r.node: r.component for r in common.components(frame(spark, edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(-100, 101), -100), 500: 500, 501: 500}
    assert (len(tables) <= 2) == (edge_rows > 200)


def test_tied_nodes_have_their_smallest_one():
    draw = random.Random(3)
    for _ in range(50):
        edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(draw.randint(1, 60))]
        least = {n: n for e in edges for n in e}
        for _ in range(60):
            for a, b in edges:
                least[a] = least[b] = min(least[a], least[b])
        a, b = np.array(edges, np.int64).T
        assert dict(zip(*(x.tolist() for x in common.tied(a, b)), strict=True)) == {n: m for n, m in least.items() if n != m}


# --- 8 -----------------------------------------------------------------------------------------------------

def jump(key, shards):
    bucket, to, key = -1, 0, key % (1 << 64)
    while to < shards:
        bucket = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


def test_sharding(spark, odd_rows, empty):
    rows = odd_rows + [(-k * 7919, f"t{k}") for k in range(1, 400)] + [(1 << 62, "z"), (-(1 << 63), "y")]
    out = sharding.shard(frame(spark, rows, "doc_id bigint, text string"), 24, block_rows=5).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25)) and r.grown_shard in (r.shard, 24) and r.law == "key"
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in out if r.doc_id is not None) == want
    for s in range(24):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(empty, 24).count() == 0 and {r.shard for r in sharding.shard(frame(spark, odd_rows, "doc_id bigint, text string"), 1).collect()} == {0}


# --- 9 and 10 ----------------------------------------------------------------------------------------------

def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    triples = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines), "n_dup_lines": dup,
            "n_repeat_words": len(repeated), "n_distinct_words": len(set(w))}


def test_text_counts(odd, odd_rows, empty):
    out = odd.select(text_stats.text_counts(F.col("text")).alias("c")).select("c.*").collect()
    for (_, text), got in zip(odd_rows, out, strict=True):
        assert {k: got[k] for k in plain_counts(text)} == plain_counts(text)
    draw = random.Random(12)
    texts = ["".join(draw.choice("ab \n#é") for _ in range(draw.randint(0, 80))) for _ in range(500)]
    counts = text_stats.count_texts([t.encode() for t in texts])
    for k, text in enumerate(texts):
        assert {n: counts[n][k] for n in plain_counts(text)} == plain_counts(text)
    assert empty.select(text_stats.text_counts(F.col("text")).alias("c")).count() == 0


def corpus(draw):
    rows = []
    for k in range(600):
        lang, source = draw.choice(["en", "de", None]), draw.choice(["big", "big", "big", f"s{k % 40}"])
        text = words(draw, draw.randint(60, 200)).capitalize() + ".\n" + words(draw, 30) + "."
        kind = "clean"
        if k % 9 == 0:
            kind, text = "junk", " ".join(w + draw.choice(["###", "$$$", "%%%"]) for w in text.split())
        if k % 17 == 0:
            kind, text = "junk", text.upper().replace(" ", "!! ")
        rows.append((k, text, lang, source, 5, kind))
    return rows


def test_rules_follow_the_corpus(spark, odd, odd_rows, empty):
    rows = corpus(random.Random(21))
    docs = frame(spark, rows)
    out = {r.doc_id: r for r in quality_rules.apply_rules(docs, min_rows=60).collect()}
    assert all(out[i].kept == (kind == "clean") for i, *_, kind in rows)
    assert {r.level for r in out.values()} == {"source", "lang"}
    kept = quality_rules.clean(docs, min_rows=60)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}
    for r in quality_rules.apply_rules(odd).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    assert quality_rules.apply_rules(odd).count() == len(odd_rows)
    assert quality_rules.apply_rules(empty).count() == 0 and quality_rules.clean(empty).count() == 0


@pytest.mark.parametrize("junk", [4, 9])
def test_a_source_full_of_junk_does_not_raise_its_limit(spark, junk):
    draw, rows = random.Random(31), []
    for k in range(360):
        source = ("spam", "a", "b")[k % 3]
        text = words(draw, 80).capitalize() + ".\n" + words(draw, 30) + "."
        bad = source == "spam" and (k // 3) % 10 < junk
        rows.append((k, " ".join(w + draw.choice(["###", "$$$", "%%%"]) for w in text.split()) if bad else text, "en", source, 5, "junk" if bad else "clean"))
    docs = frame(spark, rows)
    for min_rows in (60, 120):  # the spam source has 120 documents
        out = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs, min_rows=min_rows).collect()}
        assert all(out[i] == (kind == "clean") for i, *_, kind in rows)


def test_a_document_more_changes_no_fence_by_much(spark):
    """A fence moves no further than those it is made of, whose quantiles are whole numbers and go in steps; no size switches levels."""
    names = [f"max_{m}" for m in quality_rules.METRICS]
    found = []
    for n in (199, 200, 201):
        rows = [("en", "big", *([k % 50] * len(quality_rules.METRICS))) for k in range(1000)] + [("en", "own", *([20 + k % 7] * len(quality_rules.METRICS))) for k in range(n)]
        measured = spark.createDataFrame(rows, ["lang", "source", *quality_rules.METRICS])
        sketch = quality_rules.sketches(measured)
        parts = [quality_rules.fences(sketch, "lang", "source").where("source = 'own'").first(), quality_rules.fences(quality_rules.merge(sketch, "lang"), "lang").first()]
        limits = quality_rules.thresholds(measured, min_rows=200).where("source = 'own'").first()
        found.append([(limits[m], *(p[m] for p in parts)) for m in names])
    for metric in zip(*found, strict=True):
        limit, own, lang = (max(v) - min(v) for v in zip(*metric, strict=True))
        assert limit <= max(own, lang) + 2
        assert all(abs(o - g) > 20 for _, o, g in metric)  # a switch between the two would show


def test_sketches_are_close_and_merge(spark):
    draw = random.Random(2)
    values = [draw.choice([draw.randint(0, 100), draw.randint(0, 100_000)]) for _ in range(3000)]
    rows = spark.createDataFrame([("en", f"s{k % 7}", *([v] * len(quality_rules.METRICS))) for k, v in enumerate(values)], ["lang", "source", *quality_rules.METRICS])
    merged = quality_rules.merge(quality_rules.sketches(rows), "lang")
    assert merged.where("metric = 'word_length'").agg(F.sum("rows")).first()[0] == 3000
    fence = quality_rules.fences(merged, "lang").first()
    q50, q75 = (sorted(values)[-(-3000 * q // 100) - 1] for q in (50, 75))
    want = q75 + quality_rules.SPREAD * (q75 - q50) + quality_rules.METRICS["word_length"][1]
    assert abs(fence.max_word_length - want) <= (2 * quality_rules.SPREAD + 1) * q75 / 64


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(4)
    truth = draw.random(20_000) < 0.8
    accuracy, cover = np.array([0.95, 0.9, 0.7, 0.85]), np.array([1, 0.8, 0.9, 0.3])
    right = draw.random((len(truth), 4)) < accuracy
    ballots = np.where(draw.random((len(truth), 4)) < cover, np.where(right, truth[:, None], ~truth[:, None]).astype(int), quality_classifier.NONE)
    rows, counts = np.unique(ballots, axis=0, return_counts=True)
    model = quality_classifier.label_model(rows, counts.astype(float), rounds=200)
    assert abs(model.good - 0.8) < 0.03 and np.abs(model.accuracies() - accuracy).max() < 0.05
    assert ((model.posterior(ballots) > 0.5) == truth).mean() > 0.95


def test_classifier(spark, odd, odd_rows, empty):
    rows = corpus(random.Random(33))
    docs = frame(spark, rows)
    trained = quality_classifier.train(docs)
    out = {r.doc_id: r for r in quality_classifier.classify(docs.select("doc_id", "text"), trained).collect()}
    assert sum(out[i].kept == (kind == "clean") for i, *_, kind in rows) >= 0.98 * len(rows)
    held = quality_classifier.votes(text_stats.count_texts([rows[0][1].encode()]))
    assert out[0].ballot == "".join(map(str, held[0])) and abs(out[0].weak_label - trained.model.posterior(held)[0]) < 1e-9
    kept = quality_classifier.clean(docs, trained)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}
    judged = quality_classifier.classify(odd.select("doc_id", "text"), trained).collect()
    assert len(judged) == len(odd_rows) and not any(r.kept for r in judged if not (r.text or "").split())
    nothing = quality_classifier.train(empty)
    assert nothing.scorer is None and quality_classifier.classify(empty.select("doc_id", "text"), nothing).count() == 0
    assert quality_classifier.clean(empty).count() == 0


def test_rare_junk_is_rejected_whatever_the_size(spark):
    """A few bad texts among many good ones are in the sample, however small their share is."""
    draw = random.Random(5)
    good = [" ".join(words(draw, 12) for _ in range(6)) for _ in range(50)]
    rows = [(k, good[k % 50] + f" {words(draw, 3)}") for k in range(4000)] + [(k, "$$$ ### BUY!!! <<<>>> " * 20) for k in range(4000, 4003)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for sample in (100, 3000):
        trained = quality_classifier.train(docs, sample_docs=sample)
        gone = {r.doc_id for r in quality_classifier.classify(docs, trained).where("NOT kept").collect()}
        assert gone == {4000, 4001, 4002}
    alone = quality_classifier.classify(docs, quality_classifier.Classifier(trained.model, None)).collect()
    assert {r.doc_id for r in alone if not r.kept} == {4000, 4001, 4002} and all(r.score == r.weak_label for r in alone)
    nameless = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert quality_classifier.train(nameless, sample_docs=500).scorer is not None


def test_scorer_sums_what_the_features_hold():
    draw = random.Random(1)
    texts = [words(draw, draw.randint(0, 50)).encode() for _ in range(40)] + [b"", "é".encode()]
    c = text_stats.count_texts(texts)
    scorer = quality_classifier.Scorer(np.random.default_rng(0).normal(size=1 << quality_classifier.BITS), 0.3)
    plain = quality_classifier.features(texts, c).astype(float) @ scorer.weights + scorer.bias
    assert np.allclose(1 / (1 + np.exp(-np.clip(plain, -30, 30))), scorer.score(texts, c), atol=1e-4)


def test_labels_are_met_on_given_data(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = quality_classifier.classify(docs.select("doc_id", "text"), quality_classifier.train(docs)).join(labels, "doc_id").toPandas()
    assert out.loc[out.quality == 1, "kept"].mean() > 0.98 and out.loc[out.quality == 0, "kept"].mean() < 0.03
    assert isinstance(out, pd.DataFrame)


def test_workers_drop_the_vocabulary_after_a_task(spark):
    """Workers that other stages use again hold no tables of the round trip."""
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(8)], "doc_id bigint, text string").repartition(4)
    assert bpe.round_trip(docs).count() == 8 and len(bpe.round_trip(docs).collect()) == 8

    def held(batches):
        import pyarrow as pa
        from tidemark.llm import bpe as used
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([used.vocabulary.cache_info().currsize] * batch.num_rows)], names=["n"])

    assert {r.n for r in docs.mapInArrow(held, "n bigint").collect()} == {0}
