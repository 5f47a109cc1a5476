"""Repeated line runs against brute force; main text, archives."""

import gzip
import hashlib
import io
import random

import pytest

from wardlight.llm import html_text as H
from wardlight.llm import line_dedup as L
from wardlight.llm import warc as W


def brute_force(rows, least):
    """doc -> (text, lines, deleted), by comparing every window with every earlier one."""
    docs = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [(n, x) for n, x in enumerate((text or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
        docs.append((doc_id, text, lines, [x.strip(" \t\n\x0b\x0c\r") for _, x in lines], [len(x.split()) for _, x in lines]))
    ends = []
    for *_, counts in docs:
        ends.append([next((e for e in range(s + 1, len(counts) + 1) if sum(counts[s:e]) >= least), None) for s in range(len(counts))])
    out = {}
    for d, (doc_id, text, lines, bare, _) in enumerate(docs):
        gone = set()
        for start, end in enumerate(ends[d]):
            if end is None:
                continue
            earlier = [(o, s) for o in range(d + 1) for s, e in enumerate(ends[o]) if e and docs[o][3][s:e] == bare[start:end] and (o, s) < (d, start)]
            if not earlier:
                continue

            def tail(doc, at):
                nxt = ends[doc][at + 1] if at + 1 < len(ends[doc]) else None
                return docs[doc][3][ends[doc][at] : (nxt - 1 if nxt else len(docs[doc][3]))]

            more = 0
            for o, s in earlier:
                same = [x == y for x, y in zip(tail(d, start), tail(o, s), strict=False)]
                more = max(more, [*same, False].index(False))
            gone.update(lines[i][0] for i in range(start, end + more))
        kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        out[doc_id] = (kept, len(lines), len(gone))
    return out


def test_repeated_runs_are_those_of_brute_force(spark):
    rnd = random.Random(2)
    line = lambda: " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(1, 6)))
    pool = [[line() for _ in range(rnd.randrange(1, 8))] for _ in range(8)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rnd.randrange(6)):
            text += rnd.choice(pool) if rnd.random() < 0.5 else [line(), "", " " + line() + "\t"]
        rows.append((i * 7 % 61, "\n".join(text)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "x y z\n" * 40), (104, "many words " * 5000), (105, "many words " * 5000)]
    df = spark.createDataFrame([(i, t, 3, "e") for i, t in rows], "doc_id bigint, text string, n_lines int, `end` string")
    out = L.delete_repeats(df, least_words=10)
    assert out.columns == ["doc_id", "text", "n_lines", "end", "n_lines_", "n_deleted"]
    assert {r["n_lines"] for r in out.collect()} == {3}
    found = {r["doc_id"]: (r["text"], r["n_lines_"], r["n_deleted"]) for r in out.collect()}
    assert found == brute_force(rows, 10)
    assert L.delete_repeats(df.limit(0)).collect() == []


def by_definition(rows, least):
    """doc -> text without the lines of any run of that many words that stands at an earlier place too."""
    places, bare, full, counts = {}, {}, {}, {}
    for doc, text in sorted(rows):
        full[doc] = [n for n, x in enumerate(text.split("\n")) if x.strip()]
        bare[doc] = [text.split("\n")[n].strip() for n in full[doc]]
        counts[doc] = [len(x.split()) for x in bare[doc]]
        for s in range(len(bare[doc])):
            for e in range(s + 1, len(bare[doc]) + 1):
                if sum(counts[doc][s:e]) >= least:
                    places.setdefault(tuple(bare[doc][s:e]), []).append((doc, s))
    gone = {doc: set() for doc in bare}
    for run, found in places.items():
        for doc, s in found:
            if (doc, s) > min(found):
                gone[doc].update(full[doc][s : s + len(run)])
    return {doc: "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[doc]) for doc, text in rows}


def test_runs_are_followed_along_every_earlier_place(spark):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    shared, short = words("w", 12), "a short line"
    rows = [
        (1, "\n".join([shared, words("z", 15)])),
        (2, "\n".join([shared, short, words("b", 15)])),
        (3, "\n".join([shared, short, words("c", 15)])),
        (4, "\n".join([shared, short, "another", words("d", 15)])),
        (5, "\n".join([words("e", 15), shared, short, "another"])),
    ]
    rnd = random.Random(9)
    parts = [shared, short, "another", "one more", words("x", 5), words("y", 11), words("v", 30)]
    rows += [(i, "\n".join(rnd.choice(parts) for _ in range(rnd.randrange(9)))) for i in range(6, 90)]
    out = L.delete_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=10)
    found = {r["doc_id"]: r["text"] for r in out.collect()}
    assert found == by_definition(rows, 10)
    assert found[3] == words("c", 15) and found[5] == words("e", 15)


def test_equal_rows_are_one_place_and_null_ids_come_last(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (5, text), (5, text), (7, text)]
    out = L.delete_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=10).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == [(0, ""), (5, text), (5, text), (7, "")]


def test_a_shared_run_shares_a_fingerprint():
    run = [f"line {i} of the shared run" for i in range(12)]
    a = list(L.windows("\n".join(["before it", *run, "behind"]), 20))
    b = list(L.windows("\n".join(["other", "words here", *run]), 20))
    assert {x[:2] for x in a} & {x[:2] for x in b}


PAGE = """<html><head><title>T</title><script>if (a<b) { "</p>" }</script></head><body class="no-sidebar"><header><p>Site name and slogan</p></header>
<div id="cookie-notice">We use cookies and would like you to accept every one of them.</div><nav><a href=x>Home</a></nav>
<div class="content"><h2>A   title</h2><p>First paragraph with <b>many</b> words &amp; more of them,<br>and on it goes for a while.</p><p>Short.</p>
<p>Another one &eacute; that is long enough to count as dense text by any measure.<script>x()</script></p>
<form><label>Your mail address please, so that we can write to you</label></form></div>
<aside>A sidebar with a long text that could be taken for an article by its length alone.</aside>
<section id="comments"><article class="comment"><p>I am a reader and have a long opinion on all of this here.</p></article></section>
<footer>Imprint &copy; someone</footer></body></html>"""
TEXT = "A title\nFirst paragraph with many words & more of them, and on it goes for a while.\nShort.\nAnother one é that is long enough to count as dense text by any measure."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, TEXT),
        (PAGE.replace('<div class="content">', "<main><article>").replace("</form></div>", "</form></article></main>"), TEXT),
        (PAGE.split("</form>")[0], TEXT),
        ("plain text &lt;only&gt;", "plain text <only>"),
        ("<p>a<p>b&#x41;", "a\nbA"),
        ("<article><p>x</p><p><b>y<br></article><footer>z</footer>", "x\ny"),
        ("<nav><a href=1>m</a></nav>", ""),
        ("<p hidden>no</p>", ""),
        ("", ""),
        (None, ""),
        ("<" * 50 + "!--", None),
    ],
)
def test_main_text(page, text):
    found = H.extract(page)
    assert text is None or found == text


LONG = "This is a long paragraph of the article, with so many words that it counts as dense text by any measure at all."


@pytest.mark.parametrize(
    "page",
    [
        "<nav><a href=x>m</a></nav><article class='post category-legal'>{}</article><footer>z</footer>",
        "<article class='tag-social'>{}</article>",
        "<article class=legal>{}</article>",
        "<div class=commentary>{}</div>",
        "<div class=response>{}</div>",
        "<div class=legal>{}</div>",
        "<div id=all><div class=elementor-widget-text-editor>{}</div></div>",
        "<article><div class='elementor-widget elementor-widget-text-editor'>{}</div></article>",
        "<article class=post><div class=widget>{}</div></article>",
    ],
)
def test_no_name_takes_an_article(page):
    texts = [f"{n}. {LONG}" for n in range(4)]
    assert H.extract(page.format("".join(f"<p>{x}</p>" for x in texts))) == "\n".join(texts)
    before, behind = page.split("{}")
    at, end = before.rindex("<"), behind.index(">") + 1
    if not before[at:].startswith("<article"):
        apart = "".join(f"{before[at:]}<p>{x}</p>{behind[:end]}" for x in texts)
        assert H.extract(before[:at] + apart + behind[end:]) == "\n".join(texts)


def test_every_dense_region_stays():
    text = "".join(f"<p>{n}. {LONG}</p>" for n in range(6))
    whole = [f"{n}. {LONG}" for n in range(6)]
    lead = f"Lead: {LONG}"
    page = f"<body><nav><a href=x>Home</a></nav><h1>Title</h1><div class=intro><p>{lead}</p></div><div class=text>{text}</div><footer>z</footer></body>"
    assert H.extract(page) == "\n".join(["Title", lead, *whole])
    parts = f"<body><article><p>{lead}</p><p>Short.</p></article><article>{text}</article></body>"
    assert H.extract(parts) == "\n".join([lead, "Short.", *whole])
    mixed = f"<body><div><div><p>{lead}</p></div></div><article>{text}</article><section class=comments><article><p>No!</p></article></section></body>"
    assert H.extract(mixed) == "\n".join([lead, *whole])


def test_names_weigh_lines():
    comments = "".join(f"<li class=comment><p>{n} I beg to differ.</p></li>" for n in range(9))
    page = f"<div class=ad>Buy this now.</div><div class=text><p>{LONG}</p><p>{LONG}</p></div><ol class=comment-list>{comments}</ol>"
    assert H.extract(page) == f"{LONG}\n{LONG}"
    assert H.extract(f"<div class=legal><p>{LONG}</p></div><div class=social><p>{LONG}</p></div>") == f"{LONG}\n{LONG}"


def test_pages(spark):
    rows = [(1, "u", PAGE, "a"), (1, "u", PAGE, "b"), (None, None, None, "c"), (3, "v", "<p>" + "long text " * 20000, "d")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in H.extract_pages(df).collect()), key=str)
    long = ("long text " * 20000).strip()
    assert out == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (3, "v", long, len(long))], key=str)
    assert H.extract_pages(df.limit(0)).collect() == []


def test_smoothing_and_threshold():
    import numpy as np

    assert np.allclose(H.smooth(np.ones(5)), 1)
    assert 1 < H.threshold(np.array([0.0, 1, 9, 10])) < 9
    assert H.threshold(np.array([3.0, 3.0])) == 3


def test_members_are_plain_gzip_and_damage_is_found():
    blocks = [b"", b"x" * 10, bytes(range(256)) * 2000]
    data = b"".join(W.record(i, f"http://a/{i}\n%", b, hashlib.sha256(b).hexdigest(), None) for i, b in enumerate(blocks))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 3
    for chunk in (1, 7, 1 << 16):
        found = [W.parse_record(c)[1] for _, c in W.read_members(io.BytesIO(data), chunk)]
        assert found == blocks
    offsets = [o for o, _ in W.read_members(io.BytesIO(data))]
    assert W.parse_record(next(W.read_members(io.BytesIO(data[offsets[2] :])))[1])[1] == blocks[2]
    with pytest.raises(W.DamagedArchive):
        list(W.read_members(io.BytesIO(data[:-3])))
    content = next(W.read_members(io.BytesIO(data)))[1]
    with pytest.raises(W.DamagedArchive):
        W.parse_record(content + b"x")
    with pytest.raises(W.DamagedArchive):
        W.parse_record(content.replace(b"WARC-Block-Digest: sha256:e", b"WARC-Block-Digest: sha256:f"))


def test_archives_round_trip(spark, tmp_path):
    same, short = "same payload é " * 20, "short"
    rows = [(5, "http://a/%0A", same, 1), (3, "b", same, 1), (9, None, same, 1), (1, "c", short, 1), (2, "c", short, 1)]
    rows += [(4, "d", None, 1), (6, "e\r\nf", "", 1), (None, "g", same, 1), (3, "b", same, 1), (10, "h", "z" * 300_000, 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int")
    folder = f"file://{tmp_path}/archives"
    manifest = W.write_archives(W.plan_records(df), folder, archive_bytes=500)
    out = W.read_archives(manifest, folder).collect()
    found = sorted(((r["page_id"], r["url"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in out), key=str)
    expected = []
    for page, url, html, _ in rows:
        size = len((html or "").encode())
        first = 3 if html == same and page != 3 else None
        expected.append((page, url, size, "revisit" if first else "response", first))
    assert found == sorted(expected, key=str)
    for r in out:
        html = {x[0]: x[2] for x in rows}[r["page_id"]] or ""
        assert r["payload_digest"] == hashlib.sha256(html.encode()).hexdigest()
        assert bytes(r["payload"]) == html.encode() if r["record_type"] == "response" else r["payload"] is None
    assert W.archive_round_trip(df.limit(0)).collect() == []


PARTS = ["alpha ", "beta1 ", "gamma ", "delta ", "epsil "]


@pytest.mark.parametrize("lead", ["", "<div class=intro><p>" + "a lead of some words " * 5 + "</p></div>"])
def test_title_and_lead_before_the_container_of_the_text_stay(lead):
    body = "".join(f"<p>{w * 100}</p>" for w in PARTS)
    out = H.extract(f"<body><nav><a>menu</a></nav><h1>TITLE</h1>{lead}<div class=text>{body}</div></body>").split("\n")
    assert out[0] == "TITLE" and len(out) == 6 + bool(lead) and "menu" not in out


@pytest.mark.parametrize("menu", ["", '<div class="menu"><a>Home</a> <a>About</a></div>'])
@pytest.mark.parametrize("named", ['<section class="comments"><p>{}</p></section>', '<div class="sidebar"><p>{}</p></div>', '<div class="ad">{}</div>'])
def test_long_comments_and_adverts_go_whatever_menus_the_page_has(menu, named):
    body, other = "".join(f"<p>{w * 50}</p>" for w in PARTS[:3]), named.format("other words here " * 25)
    for page in (f"<body>{menu}<div class=text>{body}</div>{other}</body>", f"<body>{menu}<article>{body}</article>{other}</body>", f"<body>{menu}<div>{body}{other}</div></body>"):
        out = H.extract(page)
        assert len(out.split("\n")) == 3 and "other" not in out and "Home" not in out


def test_columns_called_like_the_counts_stay(spark):
    df = spark.createDataFrame([(1, "a b\nc", 7, "x")], "doc_id bigint, text string, n_lines int, n_deleted string")
    assert tuple(L.delete_repeats(df).first()) == (1, "a b\nc", 7, "x", 2, 0)
    assert L.delete_repeats(df).columns == ["doc_id", "text", "n_lines", "n_deleted", "n_lines_", "n_deleted_"]
    assert L.delete_repeats(df, counts=False).columns == df.columns
