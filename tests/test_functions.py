from pyspark.sql import functions as F

from chunkwright.functions import citations, html, render, text


def one(spark, function, *args, x):
    return _one(spark, function(F.col("x"), *args), x=x)


def _one(spark, column, **values):
    fields = ", ".join(f"{k} string" if isinstance(v, str) or v is None else f"{k} {'array<string>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], fields).select(column.alias("x")).first()["x"]


def test_tokens(spark):
    assert one(spark, text.tokens, x="What is RAG? GPT-4 a") == ["what", "is", "rag", "gpt"]
    assert one(spark, text.tokens, x="") == []


def test_time_label(spark):
    got = [one(spark, lambda c: text.time_label(c.cast("bigint")), x=v) for v in ("65", "3725", None)]
    assert got == ["1:05", "1:02:05", None]


def test_citation(spark):
    def cite(corpus, title, url, slide=None, seconds=None):
        row = spark.createDataFrame([(corpus, title, url, slide, seconds)], "a string, b string, c string, d long, e long")
        return tuple(row.select(citations.citation(*map(F.col, "abcde")).alias("r")).first()["r"])

    assert cite("x", "R", "http://x/r.PDF?v=1", 3)[:2] == ("http://x/r.PDF?v=1#page=3", "R, p. 3")
    assert cite("x", "  ", "u") == ("u", None, None)
    assert cite("memes", "R", "u") == (None, None, None)
    assert cite("youtube", "T", "u", None, 65) == ("u", "T, 1:05", '<a href="u">T, 1:05</a>')
    assert cite("lecturer/lectures", "T", "u", 2)[:2] == ("u", "T, slide 2")


def test_snippet(spark):
    assert one(spark, text.snippet, x="a" * 240) == "a" * 240
    assert one(spark, text.snippet, x="a" * 241) == "a" * 239 + "…"
    assert one(spark, text.snippet, x=("b" * 238) + " cc dd") == "b" * 238 + "…"
    assert one(spark, text.snippet, x=" a \n\n b ") == "a b"


def test_price(spark):
    got = [one(spark, text.per_mtok, x=v) for v in ("0.0000025", "0", "x", "", "0.00000125")]
    assert got == ["$2.5 / Mtok", "$0 / Mtok", None, None, "$1.25 / Mtok"]


def test_bytes_and_dates(spark):
    assert [one(spark, text.bytes_label, x=v) for v in (512, 2048, 3 << 20, 5 << 40)] == ["512.0 B", "2.0 KB", "3.0 MB", "5120.0 GB"]
    assert one(spark, lambda c: text.iso_date(c, F.lit("f")), x="20250102") == "2025-01-02"
    assert one(spark, lambda c: text.iso_date(c, F.lit("f")), x="2025") == "f"
    assert one(spark, text.stamp_seconds, x="01:02:03.500") == 3723.5


def test_slug_and_escape(spark):
    assert one(spark, text.slugify, x="  GPT-4o (mini)! ") == "gpt-4o-mini"
    assert one(spark, text.slugify, "model", x="!!!") == "model"
    assert one(spark, text.html_escape, x="<a & \"b\" 'c'>") == "&lt;a &amp; &quot;b&quot; &#x27;c&#x27;&gt;"


def test_speaker(spark):
    r = one(spark, text.speaker, x="Ann Lee, Chief Financial Officer: Hello: all")
    assert (r["name"], r["role"], r["body"]) == ("Ann Lee", "cfo", "Hello: all")
    assert one(spark, text.speaker, x="Operator: Next")["role"] == "operator"
    assert one(spark, text.speaker, x="no speaker here") is None


def test_captions(spark):
    row = spark.createDataFrame([("c", "", "<refused>", ["t", "u"])], "a string, b string, c string, d array<string>")
    assert row.select(render.caption(*map(F.col, "abcd")).alias("x")).first()["x"] == "Caption: c\n\nTopics: t, u"


def test_model_record(spark):
    m = spark.sql(
        "SELECT named_struct('name', 'N', 'id', 'a/b', 'canonical_slug', 'a/b', 'hugging_face_id', '', 'context_length', 128000, 'architecture', named_struct('modality', 'text', 'input_modalities', array('text'), 'output_modalities', array('text'), 'tokenizer', 'T', 'instruct_type', CAST(NULL AS STRING)), 'pricing', map('prompt', '0.0000025', 'image', '0'), 'top_provider', named_struct('context_length', 0, 'max_completion_tokens', 4096, 'is_moderated', true), 'supported_parameters', array('top_p', 'seed'), 'knowledge_cutoff', '', 'description', ' D ') AS m"
    )
    assert m.select(render.model_record()).first()[0].split("\n") == [
        "N", "OpenRouter id: a/b", "Context window: 128,000 tokens", "Max completion tokens: 4,096", "Modality: text", "Modalities: input=[text], output=[text]", "Tokenizer: T",
        "Pricing (USD):", "  prompt: $2.5 / Mtok", "  image: $0 / image", "Provider moderation: enabled", "Supported parameters: seed, top_p", "", "D",
    ]


PAGE = "<html><body><nav>n</nav><article><h2 id='a'>One</h2><div>lost<p>para <b>x</b></p><h3>Sub</h3><table><tr><th>k</th><td>v</td></tr><tr><td></td></tr></table></div><section><h3>Endnotes</h3><p>z</p></section><a href='/p'><h3>Card</h3><p>sum</p></a></article></body></html>"


def test_html_structure():
    s = html.sections(PAGE)
    assert [x["heading"] for x in s] == ["__preamble__", "One"] and s[1]["anchor"] == "a"
    assert s[1]["blocks"][:3] == ["para x", "### Sub", "k | v"]
    assert "z" not in html.without_footers(PAGE, ("endnotes",)).split("\n")
    assert html.cards(PAGE, "http://h") == [{"title": "Card", "url": "http://h/p", "summary": "sum"}]
    assert "n" not in html.extract(PAGE).split("\n")
    assert html.extract(None) == ""
    assert html.extract("<div class='q et'>x</div><p>y</p>", css_class="et") == "x"
    assert html.extract("<body><div id='m'>x<br>z</div><p>y</p>", "m") == "x\nz" and html.extract("<body><p>y</p>", "m") == "y"
    assert html.extract("</b><p>a</i><nav>n</p>b") == "a\nb" and html.extract("plain") == "plain"
    assert html.charts("<a href='/grapher/a-b?x=1'>1</a><iframe src=''></iframe><a href='https://h/grapher/c#d'>2</a><a href='/grapher/a-b'>3</a>") == ["a-b", "c"]
    assert html.charts("<iframe src='/grapher/i' href='/grapher/j'></iframe><a href='/grapher/k/'>1</a><a href='/grapher/?x'>2</a>") == ["k/"]  # anchors only, slugs as they stand
    assert html.sections("<h2>A<p>in</p></h2><blockquote><p>q</p></blockquote>")[1] == {"heading": "A in", "anchor": None, "blocks": ["q"]}


def test_regex_and_parser_agree(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = pages.select("html", html.html_to_text(F.col("html")).alias("t")).collect()
    squeeze = lambda s: "".join(s.split())
    import html as std

    for r in rows:
        parsed = squeeze(html.extract(r["html"]))
        assert parsed in squeeze(std.unescape(r["t"]))


def test_html_references_need_their_semicolon():
    page = "<p>a &amp; b&amp</p><p>x &lt;y&gt; &copy=1 &unheard; &ampx; &#x27;&#65; &#65</p><h3><a href='/q?a=1&lt=2&amp;b'>t</a></h3>"
    assert html.extract(page).split("\n") == ["a & b&amp", "x <y> &copy=1 &unheard; &ampx; 'A &#65", "t"]
    assert html.parse(page).elements[-1].attrs == {"href": "/q?a=1&lt=2&b"}
    assert html.parse("<script>a && b &amp; c</script>").pieces == ["a && b &amp; c"]  # no references in scripts
