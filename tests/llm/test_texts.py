"""Secrets, line dedup, HTML, quality, mixing and packing on small tables."""

import hashlib
import math
import random
import time
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphweave.llm import quality
from glyphweave.llm.html_extraction import extract_main_text, main_text
from glyphweave.llm.line_dedup import dedup_lines
from glyphweave.llm.mixing import mix
from glyphweave.llm.packing import pack
from glyphweave.llm.queries import tokenizer_path
from glyphweave.llm.secret_scan import read_ledger, scan_versions, spans_string
from glyphweave.llm.tokens import count_tokens, encoder

PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)


def secrets_of(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[g]) >= n]
    return ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def secret_texts():
    rng = random.Random(4)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", '"', "'", " ", " ", "=", ":", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "x", "é😀", "\n", "ſecret", "abc", "a=b"]
    return ['secret=token"=abcdefg', "", None, *("".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300))]


def test_secrets_equal_brute_force(spark, edge_rows):
    rows = [*enumerate(secret_texts()), *((None if i is None else i + 1000, t) for i, t in edge_rows)]
    frame = spark.createDataFrame(rows, "path bigint, content string").withColumn("blob", F.lit(1))
    found = scan_versions(spark, frame).select("path", spans_string(F.col("spans")).alias("s")).collect()
    number = lambda i: -1 if i is None else i
    assert sorted((number(r.path), r.s) for r in found) == sorted((number(i), secrets_of(t)) for i, t in rows)
    assert scan_versions(spark, frame.limit(0)).count() == 0


def test_the_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame([("a", "token=abcdefgh"), ("b", "plain")], "path string, content string")
    two = spark.createDataFrame([("a", "token=abcdefgh"), ("a", "other"), ("c", "token=abcdefgh")], "path string, content string")
    scan_versions(spark, one, ledger=ledger).count()
    assert read_ledger(spark, ledger).count() == 2
    found = {(r.path, r.blob[:4], len(r.spans)) for r in scan_versions(spark, two, ledger=ledger).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()[:4]
    assert found == {("a", sha("token=abcdefgh"), 1), ("a", sha("other"), 0), ("c", sha("token=abcdefgh"), 1)}
    assert read_ledger(spark, ledger).count() == 3
    scan_versions(spark, two, ledger=ledger, rule_version="9").count()
    assert read_ledger(spark, ledger).groupBy("rule_version").count().count() == 2


@pytest.mark.parametrize("window", [1, 2, 3])
def test_line_dedup_equals_brute_force(spark, docs_of, edge_rows, window):
    rng = random.Random(window)
    pool = ["alpha ", " beta", "gamma", "", "delta", "five words of one line", " five more words of another\t", "a third line of many words"]
    rows = [(i * 2, "\n".join(rng.choice([*pool, "one of a kind " + str(rng.random())]) for _ in range(rng.randrange(9)))) for i in range(1, 80)]
    rows += [(7001, "a\na\na\na\na"), (7002, "license line of five words\nx1"), (7003, "y1\nlicense line of five words\ny2"), (7004, "license line"), (7005, "license line")]
    rows += [(None if i is None else i * 1001, t) for i, t in edge_rows]
    docs = docs_of(rows).withColumnRenamed("lang", "n_lines")
    places, own = defaultdict(list), {}
    order = lambda i: i if i is not None else -1
    for i, t in dict.fromkeys(rows):
        lines = (t or "").split("\n")
        full = [k for k, line in enumerate(lines) if line.strip()]
        own[(i, t)] = lines, full
        for s in range(len(full)):
            for e in range(s + 1, len(full) + 1):
                if e - s >= window or e - s == 1 and len(lines[full[s]].split()) >= 5:
                    places[tuple(lines[k].strip() for k in full[s:e])].append((order(i), t or "", s))
    expected = {}
    for (i, t), (lines, full) in own.items():
        gone = set()  # every run that is long enough and stands earlier, whatever its length
        for s in range(len(full)):
            for e in range(s + 1, len(full) + 1):
                run = tuple(lines[k].strip() for k in full[s:e])
                if run in places and e - s <= window:
                    first = min(places[run])
                    if first < (order(i), t or "", s):
                        same = range(first[2], first[2] + e - s) if first[:2] == (order(i), t or "") else ()
                        gone |= {full[j] for j in range(s, e) if j not in same}
        expected[(i, t)] = ("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t, len(full), len(gone))
    assert expected[rows[79]][0] == "a\n" * (window - 1) + "a" and expected[rows[81]][0] == "y1\ny2"
    found = dedup_lines(docs, window=window).collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_lines, r.n_removed) for r in found) == sorted((str(i), *map(lambda v: str(v) if v is None or isinstance(v, str) else v, expected[(i, t)])) for i, t in rows)
    assert dedup_lines(docs.limit(0)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
<div class="ad-slot">Buy &amp; pay</div><article class="post"><header><h1>Big &lt;title&gt;</h1></header><p>First   paragraph with <b>bold</b> and&nbsp;space.<p>Second<br>line.
<div id="cookie-notice">Cookies!</div><aside>Side</aside><form>Form</form><ul><li>item</li></ul><section class="comments"><p>I like it</p></section></article><footer>&copy;</footer></body></html>"""


def test_html_extraction(spark):
    expected = "Big <title>\nFirst paragraph with bold and space.\nSecond line.\nitem"
    assert main_text(PAGE) == expected
    assert main_text("<div class=menu><a>a</a></div><div><p>A long paragraph of text that says something.<p>And one more of these, of the same length.</div>") == "A long paragraph of text that says something.\nAnd one more of these, of the same length."
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, ""), (3, "v", None), (None, "w", "<p>plain"), (4, "x", "<" * 3000), (5, "y", "<p>" + "word " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    found = extract_main_text(frame).collect()
    assert [r.text for r in found if r.page_id == 1] == [expected] * 2
    assert {r.page_id: r.n_chars for r in found if r.page_id in (2, 3, 5)} == {2: 0, 3: 0, 5: 249_999}
    assert len(found) == len(rows) and extract_main_text(frame.limit(0)).count() == 0


def test_quality_on_held_out_documents(spark, docs_of, edge_rows):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(2, 9)))
    good = lambda: ". ".join(" ".join(word() for _ in range(rng.randrange(5, 14))).capitalize() for _ in range(rng.randrange(3, 9))) + "."
    bad = lambda: rng.choice([lambda: "!! ".join(word().upper() for _ in range(40)), lambda: " | ".join(word() for _ in range(50)), lambda: " ".join([word()] * 30)])()
    truth = {i: int(rng.random() < 0.7) for i in range(10, 700)}
    docs = docs_of([(i, good() if q else bad()) for i, q in truth.items()] + edge_rows).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, q if i % 17 else None, 0) for i, q in truth.items() if i % 2], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, labels, pseudo=50)
    found = {r.doc_id: r for r in quality.classify(docs, model).collect()}
    held = [i for i in truth if i % 2 == 0]
    assert np.mean([found[i].accepted == bool(truth[i]) for i in held]) > 0.97
    assert all(0 <= found[i].score <= 1 for i in found)
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert quality.classify(docs, quality.train(docs, none)).where("NOT accepted").count() == 0
    assert quality.classify(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


def test_mixing_meets_its_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), s) for i, s in enumerate(["big"] * 600 + ["mid"] * 200 + ["small"] * 60 + [None] * 30)]
    rows += [(5000, None, "empty"), (5001, "", "empty"), (5002, "one two", "big"), (5002, "one two", "big")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("mix_epoch", F.lit(9))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    limit = 3.0
    flat = math.log(limit) / math.log(sizes["big"] / sizes[None])  # (big / least) ** flat = limit, solved by logarithms
    found = mix(docs, repeats=limit, blocks=16).collect()
    used, times = defaultdict(int), defaultdict(int)
    for r in found:
        used[r.source] += r.mix_tokens
        times[(r.doc_id, r.source)] += 1
    for s in ("big", "mid", "small", None):
        target = round((sizes[s] / sizes["big"]) ** (1 - flat) * sizes["big"])
        assert target - 60 < used[s] <= target
    assert {k for k in times} == {(i, s) for i, _, s in rows}
    assert max(times[k] for k in times if k[0] != 5002) <= math.ceil(limit)
    first = [r for r in found if r.mix_epoch == 1]
    assert len(first) == len(rows)
    entropy = mix(docs, entropy=0.95, blocks=16).groupBy("source").agg(F.sum("mix_tokens").alias("n")).where("n > 0").collect()
    p = np.array([r.n for r in entropy]) / sum(r.n for r in entropy)
    assert abs(-(p * np.log(p)).sum() / math.log(4) - 0.95) < 0.01
    shares = np.array([n for n in sizes.values() if n]) / sum(sizes.values())
    grid = [w / w.sum() for w in (shares**e for e in np.linspace(0, 1, 2001))]  # exponents tried one by one
    best = max((w for w in grid if -(w * np.log(w)).sum() / math.log(4) >= 0.95), key=lambda w: w.max())
    assert np.allclose(np.sort(p), np.sort(best), atol=0.01)
    counted = docs.withColumn("n_tokens", count_tokens(F.col("text"), tokenizer_path()))
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    assert all(r.n_tokens == len(plain.encode(r.text or "", add_special_tokens=False).ids) for r in counted.collect())
    by_tokens = mix(counted, repeats=limit, tokens="n_tokens").collect()
    assert all(r.mix_tokens == r.n_tokens for r in by_tokens) and {(r.doc_id, r.source) for r in by_tokens} == {(i, s) for i, _, s in rows}
    half = mix(docs, entropy=0.95, budget=2000, blocks=16).agg(F.sum("mix_tokens")).first()[0]
    assert 1700 < half <= 2000
    assert mix(docs.limit(0), repeats=2.0).count() == 0


def test_packing_is_whole_and_tight(spark, docs_of, edge_rows):
    rng = random.Random(9)
    rows = [(i + 100, " ".join(rng.choice(["alpha", "beta", "gamma", "x1", "é"]) for _ in range(rng.randrange(1, 900)))) for i in range(150)] + edge_rows + [(9, "a <|endoftext|> b"), (10, "tail <|endoftext|>")]
    docs = docs_of(rows).repartition(3).withColumn("length", F.lit(1))
    out = pack(docs, tokenizer_path(), with_ids=True).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    wanted = defaultdict(list)
    for i, t in rows:
        wanted[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    for i, copies in wanted.items():
        assert sum(r.length for r in by_doc[i]) == sum(map(len, copies))
        if len(copies) == 1:
            joined = b"".join(r.ids for r in sorted(by_doc[i], key=lambda r: r.start))
            assert np.frombuffer(joined, "<u4").tolist() == copies[0]
    total = sum(r.length for r in out)
    assert total / (2048 * len(sequences)) > 0.97
    assert pack(docs.limit(0), tokenizer_path()).count() == 0


def test_fast_encoder_agrees_with_the_tokenizer_file():
    from tokenizers import Tokenizer

    tokenizer, fast = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    rng = random.Random(10)
    pool = [*" \t\n\r\x0b\x85\xa0'slltmdAbz09.,!?-éñß　​日本😀́", "<|endoftext|>", "'ll", "  "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x20000, 64)]
    for t in texts:
        assert fast(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_a_very_long_run_of_white_space_is_encoded():
    from tokenizers import Tokenizer

    tokenizer, fast = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    for t in (" " * 2_000_000, "a" + "\n" * 2_000_000 + "b <|endoftext|> c"):
        assert fast(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_pages_without_containers_keep_all_text():
    menu = "<div><a href=/>Home</a></div><div><a href=/a>About us</a></div>"
    for sizes in ([300] * 16 + [6000], [6000] + [300] * 16, [40, 300, 6000, 300, 20, 80], [50] * 9, [20_000, 10]):
        parts = ["A heading", *(f"{i} " + "word " * (n // 5) + "end." for i, n in enumerate(sizes))]
        body = f"<h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:])
        for page in (body, f"<div>{body}</div>", menu + body + menu, f"{menu}<div>{body}</div><div class=footer>end</div>"):
            assert main_text(f"<html><body>{page}</body></html>") == "\n".join(parts)
    listed = "<p>" + "word " * 60 + "</p><ul><li><a href=x>One link</a></li></ul><p>" + "word " * 60 + "</p>"
    assert "One link" in main_text(listed)
    assert main_text(menu + "<h2><a href=x>Linked title</a></h2>" + listed).startswith("Linked title")
    assert main_text("<a href=x>only</a>") == "only"


def test_html_keeps_the_whole_article():
    para = "<p>" + "word " * 40 + "end.</p>"
    body = "word " * 40 + "end."
    assert main_text(f"<main><h1>Head</h1><p>lead</p><article>{para}</article></main>") == f"Head\nlead\n{body}"
    assert main_text(f"<div role=main><h1>Head</h1><article>{para}</article><article><p>two</article></div>") == f"Head\n{body}\ntwo"
    assert main_text(f"<div><article>{para}</article><article><p>two</article></div><div><article><p>teaser</article></div>") == f"{body}\ntwo"
    assert main_text(f"<article><h1>Head</h1><article>{para}</article><article><p>two</article></article>") == f"Head\n{body}\ntwo"
    for name in ("overflow-hidden", "has-sidebar", "overflow_x_hidden no-footer", "layout-sidebar-left", "elementor-widget"):
        assert main_text(f"<div class='{name}'><p>aside</p><article>{para}<div class=share>Share</div></article></div>") == body
        if name[0] in "oh":
            assert main_text(f"<article><div class='{name}'>{para}</div></article>") == body
    assert main_text(f"<form>Search<article>{para}<form>Form</form></article></form>") == body
    for away in ("<div class=hidden>{}</div>", "<div class=site-footer>{}</div>", "<section class=comments><article>{}</article></section>", "<div class=related><article>{}</article></div>"):
        assert main_text(f"<article>{para}{para}</article>" + away.format("<p>rest")) == f"{body}\n{body}"
        assert main_text(f"<div>{para}</div>" + away.format("<p>rest")) == body


_LONG = "This is a sentence of the article that goes on for a good while, as sentences of articles do."
_P = [f"{i}. {_LONG} {_LONG}" for i in range(6)]
_PS = "".join(f"<p>{p}</p>" for p in _P)
_TEXT = "\n".join(_P)
_MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(8)) + "</ul>"
_TALK = "".join(f"<div><b>Reader {i}</b><p>{_LONG} {_LONG} {_LONG}</p></div>" for i in range(9))
_PLAIN = "".join(f"<div><span>Phone {i}</span></div>" for i in range(60))
PAGES = {
    "article": (f"<nav>{_MENU}</nav><div class=ad>Buy now.</div><article><h1>Title</h1>{_PS}</article><footer>End</footer>", f"Title\n{_TEXT}"),
    "layout names around": (f"<div class='layout with-sidebar'><article>{_PS}</article><div class=sidebar>{_MENU}</div></div>", _TEXT),
    "open to comments": (f"<article class='post comments-open'>{_PS}<section class=comments>{_TALK}</section></article>", _TEXT),
    "more comments than article": (f"<article>{_PS}</article><div id=comments>{_TALK}{_TALK}</div>", _TEXT),
    "comments as articles": (f"<article>{_PS}</article><ol class=comment-list><li><article>{_TALK}</article></li></ol>", _TEXT),
    "wrapper named like boilerplate": (f"<div class='related widget'>{_PS}</div><div class=related>Other news today</div>", _TEXT),
    "sidebar without a name": (f"<div class=c><h1>Title</h1>{_PS}</div><div class=d>{_MENU}</div>", f"Title\n{_TEXT}"),
    "title outside": (f"<div>{_MENU}</div><h1>Title</h1><div>{_PS}</div><div>{_PLAIN}</div>", f"Title\n{_TEXT}"),
    "two parts alike": (f"<div class=s>{_PS}</div><div class=s><p>{_P[0]}</p></div>", f"{_TEXT}\n{_P[0]}"),
    "text beside a part": (f"<p>{_P[1]}</p><div class=s>{_PS}</div>", f"{_P[1]}\n{_TEXT}"),
    "tables": (f"<table><tr><td>{_MENU}</td><td>{_PS}</td></tr></table>", _TEXT),
    "main with a lead": (f"<main><h1>Title</h1><p>Short lead.</p><article>{_PS}</article></main><aside>{_LONG}</aside>", f"Title\nShort lead.\n{_TEXT}"),
    "header of an article": (f"<header>Site</header><article><header><h1>Title</h1><p>By A. Writer</p></header>{_PS}</article>", f"Title\nBy A. Writer\n{_TEXT}"),
    "hidden": (f"<article>{_PS}<div hidden>{_LONG}</div><p aria-hidden=true>{_LONG}</p><p style='display: none'>{_LONG}</p></article>", _TEXT),
    "code": (f"<article><script>var a = '<p>{_LONG}';</script><style>p {{}}</style>{_PS}<noscript>{_LONG}</noscript></article>", _TEXT),
    "short lines within": (f"<article><p>Yes.</p>{_PS}<p>No.</p><h2>Then</h2><p>Maybe.</p></article>", f"Yes.\n{_TEXT}\nNo.\nThen\nMaybe."),
    "lists and quotes": (f"<article>{_PS}<ul><li>One</li><li>Two</li><li>Three</li></ul><blockquote>Quoted</blockquote><pre>a  b\n c</pre></article>", f"{_TEXT}\nOne\nTwo\nThree\nQuoted\na b c"),
    "menu within": (f"<article>{_PS}{_MENU}<p>Last.</p></article>", f"{_TEXT}\nLast."),
    "links within text": ("<article><h2><a href=x>Linked title</a></h2>" + _PS.replace("article", "<a href=y>article</a>") + "</article>", f"Linked title\n{_TEXT}"),
    "unclosed tags": (f"<body><article><p><b>Bold start<br>on<p>{_P[0]}<ul><li>One<li>Two</ul><p><i>{_P[1]}", f"Bold start on\n{_P[0]}\nOne\nTwo\n{_P[1]}"),
    "references and space": ("<article><p>a &amp;&nbsp; b\t\n&lt;c&gt; &#233;&eacute;</p>" + _PS + "</article>", f"a & b <c> éé\n{_TEXT}"),
    "notices and forms": (f"<div class=cookie-consent><p>{_LONG}</p></div><div role=dialog>{_LONG}</div><article>{_PS}<form><label>Mail</label><button>Go</button></form></article>", _TEXT),
    "form around": (f"<form id=aspnet><div>{_MENU}</div><article>{_PS}</article></form>", _TEXT),
    "several articles": (f"<div id=feed><article>{_PS}</article><article><p>{_P[2]}</p></article></div><div class=x><article><p>Teaser</p></article></div>", f"{_TEXT}\n{_P[2]}"),
    "contacts beside": (f"<div class=a>{_PS}</div><div class=b>{_PLAIN}</div>", _TEXT),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text_of_varied_pages(name):
    page, expected = PAGES[name]
    assert main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == expected


def test_clusters_decide_where_no_element_says_what_it_is():
    page, expected = PAGES["contacts beside"]
    assert main_text(page) == expected != main_text(page, clustered=False)


def test_page_costs_grow_in_proportion():
    for part, end in (("<b>x <i>", ""), ("<div>", "</p>"), ("<span class=ad>a", "</b></span>")):
        times = []
        for n in (4_000, 32_000):
            began = time.perf_counter()
            main_text(f"<p>{_LONG}</p>" + part * n + end * n)
            times.append(time.perf_counter() - began)
        assert times[1] < 24 * times[0] + 1
