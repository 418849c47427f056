from pyspark.sql import functions as F

from lexmill.functions import hashes, html
from lexmill.functions import text as T


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


def test_visible_keeps_offsets_and_line_feeds(spark):
    page = "<p\nclass='x'>Zürich</p> mail <ann@site.org> & <b>x"
    seen = one(spark, T.visible(F.lit(page)))
    assert seen == "  \n          Zürich     mail &lt;ann@site.org&gt; &    x"
    assert one(spark, T.blank_tags(F.lit("<a href='q'>t</a>"))) == " " * 12 + "t" + " " * 4
    assert one(spark, T.blank_tags(F.lit("text <unclosed tag"))) == "text " + " " * 13
    assert one(spark, T.blank_tags(F.lit(""))) == ""
    assert one(spark, T.blank_tags(F.lit(None).cast("string"))) is None


def test_visible_from_regex_and_raw_keep_length(spark):
    page = "a<script>if (1 < 2) {}</script>b<!-- c -->d<i title='>'>e</i>"
    seen = one(spark, T.visible_from_regex(F.lit(page.replace("title='>'", ""))))
    assert seen.split() == ["a", "b", "d", "e"]
    raw = html.visible_from_raw(page)
    assert len(raw) == len(page) and raw.split() == ["a", "b", "d", "e"]


def test_cleanse(spark):
    assert one(spark, T.cleanse(F.lit("  The -LRB-Big-RRB-  (Dog)\u00a0barked!\n"))) == "the big dog barked"
    assert one(spark, T.cleanse(F.lit("--"))) == ""
    assert one(spark, T.cleanse(F.lit("Ab C"), lower=False)) == "Ab C"


def test_title_is_cut_by_characters(spark):
    long = "<TITLE> é" + "ü" * 80 + "\n</TITLE>"
    assert one(spark, T.title(F.lit(long), F.lit("v"))) == "é" + "ü" * 59 + "..."
    assert one(spark, T.title(F.lit("<p>none</p>"), F.lit(" some \n text "))) == "some text"
    assert one(spark, T.title(F.lit("<title>x</title>"), F.lit(""))) is None


def test_domains(spark):
    assert one(spark, T.left_cuts(F.lit("a.b.c"))) == ["a.b.c", "b.c", "c"]
    assert one(spark, T.host(F.lit("http://WWW.Site.org:80/x/y"))) == "www.site.org"
    assert one(spark, T.host(F.lit("site.org"))) == "site.org"


def test_ids_and_keys(spark):
    url = "test://page/"
    row = spark.range(1).select(T.doc_id(F.lit(url)).alias("d"), F.lit(946730040.9).alias("t")).withColumn("s", T.stream_id(F.col("t"), F.col("d")))
    parts = row.select(T.split_stream_id(F.col("s")).alias("p"), T.store_key(F.col("d"), F.floor("t")).alias("k"), "d").first()
    assert parts["p"]["epoch_ticks"] == 946730040 and parts["p"]["doc_id"] == parts["d"]
    assert len(parts["k"]) == 20 and parts["k"][16:] == (946730040).to_bytes(4, "big")
    early = spark.range(1).select(T.store_key(T.doc_id(F.lit(url)), F.lit(-5)).alias("k"), T.split_stream_id(F.concat(F.lit("-5-"), T.doc_id(F.lit(url)))).alias("p")).first()
    assert early["k"][16:] == (-5).to_bytes(4, "big", signed=True) and early["p"]["epoch_ticks"] == -5
    try:
        one(spark, T.split_stream_id(F.lit("nonsense"))["doc_id"])
    except Exception as e:
        assert "malformed" in str(e)
    else:
        raise AssertionError("a malformed id passed")


def test_guess_media_type(spark):
    guess = lambda raw: one(spark, T.guess_media_type(F.lit(raw), F.lit(None).cast("string")))
    assert guess("short") is None
    assert guess("<!DOCTYPE HTML>" + "x" * 50) == "text/html"
    assert guess("%PDF-1.4" + "x" * 60) == "application/pdf"
    assert guess("z" * 60) is None
    assert one(spark, T.guess_media_type(F.lit("z"), F.lit("a/b"))) == "a/b"


def test_murmur_and_nilsimsa(spark):
    assert hashes.murmur3(b"foo") == -156908512 and hashes.murmur3(b"") == 0 and hashes.term_hash("") == 1
    assert hashes.murmur3(b"hello, world") == 345750399
    a, b = hashes.nilsimsa(b"The quick brown fox jumps over the lazy dog"), hashes.nilsimsa(b"The quick brown fox jumps over the lazy cat")
    c = hashes.nilsimsa(b"an altogether different sentence about packing boxes")
    assert hashes.similarity(a, a) == 128 and hashes.similarity(a, b) > hashes.similarity(a, c)
    assert one(spark, hashes.digest_similarity(F.lit(a.hex()), F.lit(b.hex()))) == hashes.similarity(a, b)


def test_clean_html_and_entities():
    made = html.cleaned('<html><head><style>p{}</style><script>x("</p>")</script></head><body class="c" id="d"><p>a &lt; b<br><a href="/q" onclick="z">l</a><!-- no --></body>')
    assert "style" not in made and "script" not in made and "class" not in made and "onclick" not in made and "no" not in made
    assert 'href="/q"' in made and "a &lt; b" in made and made.endswith("</html>")
    assert html.entities_to_unicode("a&amp;b", space_padding=True) == "a  &  b"
    assert html.entities_to_unicode("&lt;&eacute;", safe_only=True) == "&lt;é"
    assert html.unicode_to_entities("<é>") == "&lt;&#233;&gt;"
    assert html.fix_text("\u201cquote me\u201d") == '"quote me"' and html.fix_text("cafÃ©") == "café"


def test_word_text():
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>one</w:t></w:p><w:p><w:t>two</w:t></w:p></w:document>')
    assert html.word_text(out.getvalue()) == "one\ntwo" and html.word_text(b"junk") is None
