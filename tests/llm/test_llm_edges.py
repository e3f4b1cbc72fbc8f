"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns: each has a defined result."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firstmile.llm import bpe, decontam, html, langid, lm, pii, quality, queries, shard, simhash, tokenfile

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox of the house and " * 30_000
PROSE = " ".join(f"the word{i} of and to in{i}" for i in range(30))
ROWS = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, PROSE, "en", "a", len(PROSE)),
    (5, PROSE, "en", "a", len(PROSE)),
    (6, PROSE, "en", "b", len(PROSE)),
    (None, PROSE + " more", "en", "b", 9),
    (None, None, None, None, None),
    (7, "der die das und ist nicht ein eine mit von " * 8, "de", "b", 1),
    (8, "12345 !!! 678", "de", "b", 1),
    (9, "A\x00b c é" * 3, "fr", "c", 1),
]
#: Names that the operators use themselves.
EXTRA = ("_fp", "_quality", "rules", "words", "shard", "row", "range", "ids", "root", "least", "u", "_h", "item_id", "word")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def byte_bpe():
    return queries.tokenizer_file("byte_bpe_50k.json")


def word_bpe():
    return queries.tokenizer_file("word_bpe_49k.json")


OPERATORS = {
    "lm": lm.train_and_score,
    "langid": langid.train_and_predict,
    "simhash": simhash.link,
    "quality": lambda d: quality.assess(d, into="_own").select("doc_id", "_own.*"),
    "tokenfile": lambda d: tokenfile.round_trip(d, byte_bpe()),
    "pii": pii.digest,
    "bpe": lambda d: bpe.digest(d, word_bpe()),
    "shard": shard.assign,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_one_row_out_for_each_row_in(docs, name):
    found = OPERATORS[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).collect() == []


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_lm_scores_of_texts_without_words(docs):
    found = by_id(lm.train_and_score(docs))
    assert found[1][0]["n_tokens"] == found[2][0]["n_tokens"] == found[3][0]["n_tokens"] == 1
    assert found[5][0] == found[5][1]
    assert all(r["score"] < 0 and r["base_score"] < 0 for rows in found.values() for r in rows)


def test_lm_without_training_documents(spark):
    found = lm.train_and_score(spark.createDataFrame([(i, "a b") for i in range(40)], "doc_id long, text string").where("crc32(string(doc_id)) % 7 = 2"))
    rows = found.collect()
    assert rows and all((r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) for r in rows)
    assert [r["score"] for r in rows] == pytest.approx([0.0] * len(rows), abs=1e-6)


def test_language_of_texts_without_letters(docs):
    found = by_id(langid.train_and_predict(docs))
    for i in (1, 2, 3, 8):
        assert (found[i][0]["lang_pred"], found[i][0]["score"]) == ("und", 0.0)
    assert found[7][0]["lang_pred"] == "de"


def test_language_chunks_of_a_long_text(monkeypatch):
    table = langid.letters()
    text = ("Straße, où? 12 naïve " * 50).encode()
    whole = [x.tolist() for x in langid.counts_of(text, table)]
    for size in (3, 7, 64):
        monkeypatch.setattr(langid, "CHUNK", size)
        assert [x.tolist() for x in langid.counts_of(text, table)] == whole


def test_simhash_of_copies_and_nothing(docs):
    found = by_id(simhash.link(docs))
    assert {found[i][0]["_fp"] for i in (1, 2, 3)} == {0}
    assert {found[i][0]["component_id"] for i in (1, 2, 3)} == {1}
    assert {r["component_id"] for i in (5, 6) for r in found[i]} == {5}


def test_one_of_each_group_stays(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids.count("5") == 1 and "6" not in ids and {"1", "4", "7", "8", "9"} <= set(ids) and not {"2", "3"} & set(ids)


def test_quality_of_texts(docs):
    found = by_id(quality.assess(docs, into="_own").select("doc_id", "_own.*"))
    assert found[1][0]["n_words"] == 0 and found[1][0]["base_failed"]
    assert found[4][0]["n_repeat_words"] == found[4][0]["n_words"] and not found[4][0]["kept"]
    assert found[5][0]["kept"] and found[5][0]["broken"] == []
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_table_is_a_parameter(docs):
    strict = (quality.Bound("any_symbol", "n_symbols", high=-1),)
    assert quality.keep_good(docs, strict).count() == 0


def test_pii_validators_and_context():
    text = "card 4111 1111 1111 1111 and 4111 1111 1111 1112, iban GB82 WEST 1234 5698 7654 32, ssn 123-45-6789, id 123-45-6789"
    kinds = [k for _, _, k, _ in pii.spans(text)]
    assert kinds.count("card") == 1 and "iban" in kinds
    assert [k for *_, k, _ in pii.spans("social security 123-45-6789")] == ["ssn"]
    assert pii.spans("part 123-45-6789") == []
    assert pii.redact_text("write to a.b@c.example or +1 (499) 555-6503.") == "write to <email> or <phone>."
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")


def test_ibans_beside_cards_and_codes():
    code = "GB39WEST36075983867565"
    assert pii.luhn(code[8:]) and {("iban", 5, 27), ("card", 13, 27)} == {(k, a, b) for a, b, k, _ in pii.spans(f"iban {code}")}
    assert pii.redact_text(f"pay {code} now") == "pay <iban> now"
    assert pii.redact_text("code AB12 GB82 WEST 1234 5698 7654 32 end") == "code AB12 <iban> end"
    assert pii.redact_text(f"GB82 WEST 1234 5698 7654 32 {code}") == "<iban> <iban>"


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 60_000, "+1 " * 60_000, "a" * 200_000 + "@", "GB82 " * 40_000])
def test_pii_is_linear(text):
    pii.spans(text)


def test_redacted_documents(docs):
    found = pii.redact(docs)
    assert found.columns == docs.columns
    assert {r["doc_id"]: r["n_chars"] for r in found.collect()}[8] == 13


def test_files_are_opened_one_document_at_a_time(spark, docs, tmp_path):
    made = tokenfile.write(docs, byte_bpe(), str(tmp_path / "t"))
    assert tokenfile.read_document(spark, made, 1) == [[0]]
    assert len(tokenfile.read_document(spark, made, 5)) == 2
    assert tokenfile.read_document(spark, made, 99) == []


def test_decontamination_of_odd_rows(spark, docs):
    text = "What is the colour of the zebra in the old town hall? It is striped black and white all over."
    items = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (None, "y z")], "item_id long, text string")
    rows = [(1, f"aa {text.upper()} bb"), (1, f"aa {text.upper()} bb"), (2, text.replace(" ", "*** ")), (3, None), (4, ""), (5, text[:50]), (None, "clean")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontam.matches(given, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(1, 1), (2, 1)]
    assert sorted(str(r["doc_id"]) for r in decontam.remove_leaks(given, items).collect()) == ["3", "4", "5", "None"]
    assert decontam.matches(given, items.limit(0)).collect() == []
    assert decontam.remove_leaks(docs, items).columns == docs.columns


def test_items_without_an_answer_are_found_as_a_whole(spark):
    item = "Inha from eder thes the eroundth. Onnthe rest onthsh onen lytion inon lyoren for as thantionsh. It went well that day. Er."
    asked = "What is the name of the river that runs through the old town of Erblest? Answer: the slow river Inan"
    items = spark.createDataFrame([(1, item), (2, item[:-4]), (3, asked)], "item_id long, text string")
    rows = [(1, f"aa bb {item[:-27]} cc dd"), (2, f"aa {item.replace('went', 'goes')} bb"), (3, item.replace(" Er.", "")), (4, asked.replace("river Inan", "stream Inan")), (5, asked[:75]), (6, "Er. It went well that day. Er.")]
    found = decontam.matches(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 3)]


def test_short_parts_are_compared_by_words():
    part = b"it went well that day".split()
    assert decontam.overlap(part, b"x it went badly that day y".split()) == 0.8
    assert decontam.overlap(part, b"it a b c d e f went g h i j k l well".split()) == 0
    assert decontam.overlap([b"a", b"a"], [b"a"]) == 0 and decontam.overlap([b"er"], [b"x"] * 9) == 0 and decontam.overlap([b"er"], []) == 0


PAGE = (
    "<html><head><title>x</title></head><body><header>Site {n}</header><nav><a href='/'>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><main><article><h1>Title {n}</h1><p>First &amp; {n}<br>line"
    "<p>Second <b>bold</b> text<ul><li>one<li>two</ul><form>Sign up</form><div id=comments><p>Nice!</p></div>"
    "<aside>More</aside></article></main><script>if (a<b) document.write('<p>no</p>')</script><footer>End</footer></body></html>"
)
PLAIN = "<body><div class=top>Our site</div><div class=story><p>{0} words make this page longer than its frame, by far.<p>And {0} more.</div><div class=end>All rights</div>"


def test_html_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("{n}", str(i))) for i in range(3)]
    rows += [(10 + i, "http://p.example/", PLAIN.format("many " * (i + 5))) for i in range(3)]
    rows += [(20, None, None), (21, "", ""), (22, "x", "just text"), (23, "http://[", "<p>a<p \"b<p>c"), (24, "http://h.example/9", "<p>no article"), (0, "http://h.example/0", PAGE.replace("{n}", "0"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rules", F.lit("x")).withColumn("_host", F.lit("y"))
    got = html.extract(pages).collect()
    assert len(got) == len(rows)
    found = {r["page_id"]: r["text"] for r in got}
    assert found[1] == "Title 1\nFirst & 1 line\nSecond bold text\none\ntwo"
    assert found[10].startswith("many many") and found[10].endswith("more.") and "Our site" not in found[10] and "rights" not in found[10]
    assert (found[20], found[21], found[22], found[24]) == ("", "", "just text", "no article")
    assert html.extract(pages.limit(0)).collect() == []


def test_wrappers_align():
    pages = [html.wrapper(html.parse(x)) for x in ("<ul><li>a</li><li>b</li></ul><p>same</p>", "<ul><li>c</li></ul><hr><p>same</p>")]
    both = html.align(*pages)
    assert html.as_text(both) == "<#><ul>(<li>#TEXT</li>)+</ul>(<hr></hr>)?<p>same</p></#>"
    assert html.as_text(html.align(*pages[::-1])) == html.as_text(both)


def test_classes_that_only_speak_of_other_parts():
    page = "<body class='has-sidebar home'><div class='content with-comments'><p>Long text of the article.</p><div class='post-comments'>x</div></div><div class='sidebar-left'>y</div></body>"
    assert html.main_text(page, None) == "Long text of the article."


def test_a_host_of_many_class_names_is_read_by_tags():
    pages = [f"<body><div class='c{'abcdefghijklmnopqrstuvwxyz'[i]}'><article><p>text {i}</p><div class='ad'>no</div></article></div></body>" for i in range(26)]
    whole = None
    for page in pages:
        whole = html.merged(whole, html.wrapper(html.parse(page)))
    assert html._size(whole) < 12 and html.as_text(whole).startswith("<#><body>(<div><article><p>#TEXT</p>")
    assert [html.text_of(html.parse(p), html.rules(whole)) for p in pages] == [f"text {i}" for i in range(26)]


@pytest.mark.parametrize("source", ["<" * 100_000, "<a \"" * 30_000, "<div>" * 50_000, "<p>" * 50_000 + "x", "<!--" * 30_000, "<script>" * 20_000, "</p>" * 50_000])
def test_html_is_linear(source):
    html.main_text(source, None)


def test_raw_text_ends_on_pages_whose_lower_case_is_longer():
    page = "<head><TITLE>\u0130stanbul</Title><script>x</SCRIPT></head><body><article><p>Text of \u0130zmir.</p></article></body>"
    assert html.main_text(page, None) == "Text of \u0130zmir."
    assert html.main_text("<title>\u017ftyle</title><style>a</\u017ftyle>b</style><p>c", None) == "c"


def test_html_of_any_depth():
    deep = "<div>" * 70 + "<p>deep</p><nav><p>no</p></nav>" + "</div>" * 70
    assert html.main_text(f"<div id=wrap><article><p>a</p>{deep}<p>after</p></article></div>", None) == "a\ndeep\nafter"
    page = "<article>" + "<div>" * 20_000 + "<p>deep</p>" + "</div>" * 20_000 + "<p>after</p></article>"
    whole = html.unpacked(html.packed(html.merged(html.wrapper(html.parse(page)), html.wrapper(html.parse(page)))))
    assert html.text_of(html.parse(page), html.rules(whole)) == "deep\nafter" and html.as_text(whole)


def test_only_the_group_that_is_too_wide_forgets_classes():
    letters = "abcdefghijklmnopqrstuvwxyz"
    pages = [f"<body><div class=side><p>no {i}</p></div><div class=list>" + "".join(f"<i class='x{i}{k}'>y</i>" for k in letters[:8]) + f"</div><div class=post><article><p>text {i}</p></article></div></body>" for i in letters]
    whole = None
    for page in pages:
        whole = html.merged(whole, html.wrapper(html.parse(page)))
    assert [html.text_of(html.parse(p), html.rules(whole)) for p in pages] == [f"text {i}" for i in letters]
    assert {w[html.NAME] for w in html._walk(whole) if w[html.TAG] == "div"} == {"side", "list", "post"}
    assert {w[html.NAME] for w in html._walk(whole) if w[html.TAG] == "i"} == {html.OPEN}
    found = html.rules(html.unpacked(html.packed(whole)))
    assert html.main_text("<body><div class=other><article><p>x</p></article></div></body>", found) == "x"


def by_host(pages):
    """The texts of a host's pages."""
    whole = None
    for page in pages:
        whole = html.merged(whole, html.wrapper(html.parse(page)))
    found = html.rules(whole)
    return [html.main_text(page, found) for page in pages]


def test_constant_texts_go_only_where_distinct_pages_agree():
    story = "<div class=story><h2>A</h2><p>x</p><p>y</p><h2>B</h2><p>z</p></div>"
    assert by_host([story]) == by_host([story, story])[:1] == [html.main_text(story, None)] == ["A\nx\ny\nB\nz"]
    assert html.main_text("<h1>T</h1><p>x</p><p>y</p>", None) == "T\nx\ny"
    pages = [f"<div class=story><h2>First {i}</h2><p>x{i}<p>y{i}<h2>B{i}</h2><p>Follow us</p><h2>C</h2><p>The longest text of page {i}</p></div>" for i in range(3)]
    pages.append("<div class=story><h2>First 9</h2><p>Follow us</p><p>y</p><h2>C</h2><p>The longest text of page 9</p></div>")
    for got, i in zip(by_host(pages), (0, 1, 2), strict=False):
        assert {f"First {i}", f"x{i}", f"y{i}", f"B{i}", f"The longest text of page {i}"} <= set(got.split("\n"))
    assert "Follow us" in by_host(pages)[3].split("\n")
    framed = [f"<div class=top>Our <b>site</b></div><div class=story><p>By <i>A{i}</i></p><p>The longest text of page {i}</p></div><div class=end>Rights</div>" for i in range(3)]
    assert by_host(framed) == [f"By A{i}\nThe longest text of page {i}" for i in range(3)]


def test_no_block_is_left_out_for_being_short():
    one = f"<body><div class=post><p>{'a' * 200}</p><ul><li>{'b' * 400}</li></ul></div></body>"
    assert html.main_text(one, None) == f"{'a' * 200}\n{'b' * 400}"
    assert html.main_text(f"<div><div class=intro>in</div><div class=text>{'b' * 400}</div></div>", None) == f"in\n{'b' * 400}"
    parts = [f"<div class=intro>in {i}</div><section><p>{'long text ' * 90}{i}</p></section><section><p>s{i}</p></section>" for i in range(3)]
    assert [x.split("\n")[0] for x in by_host(parts)] == ["in 0", "in 1", "in 2"]
    links = "<body><div class=top><a href='/'>Home</a> | <a href='/b'>B</a></div><div class=post><h1><a href=/x>Title</a></h1><div><p>Text</p></div></div></body>"
    assert html.main_text(links, None) == "Title\nText"
    assert by_host(["<body><div><p>short</p></div></body>", f"<body><div><p>{'long ' * 99}</p></div><table><tr><td>t</td></tr></table></body>"])[1].endswith("\nt")


def test_article_text_is_not_dropped_for_a_word_of_its_name():
    body = (
        "<section id='related-work'><h2 id='search'>Search</h2><p class='share-price'>Price</p></section><h2 id='notice-of-change'>Change</h2>"
        "<div id='contact-form'><p>Write to us</p></div><div class=section id=notice><h3>Notice</h3><p>of it</p></div><section id=banner><p>Banner</p></section>"
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math>.</p>"
    )
    gone = "<div class='ad-banner'>no</div><div class=share>no</div><div id=comments><h2>Comments</h2><p>no</p></div><div id=sidebar><p>no</p></div><nav>no</nav>"
    text = "Search\nPrice\nChange\nWrite to us\nNotice\nof it\nBanner\nLet x=2."
    assert html.main_text(f"<article>{body}{gone}</article>", None) == text
    assert html.main_text("<div><h2 id=search>Search</h2><p class=share-price>Price</p><div class=share-price>no</div></div>", None) == "Search\nPrice"


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, "What is this? That.")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    now = plain
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == plain.columns
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["5", "None"] or [r["doc_id"] for r in found] == [5]
