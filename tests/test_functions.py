import random
import uuid

import pytest
from pyspark.sql import functions as F

from sightline.functions import ids, jsonx
from sightline.functions import text as tx
from sightline.functions import url as ur
from sightline.functions.folding import fold, fold_with_extra, folding
from sightline.operators.terms import match_spans, term_table


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name", ["", "a|b", "Straße", "品牌"])
def test_uuid5_matches_python(spark, name):
    assert value(spark, ids.uuid5(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_evidence_id_is_the_json_list(spark):
    got = value(spark, ids.evidence_id(ids.text_part(F.lit('a"é')), ids.number_part(F.lit(3)), None))
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, '["a\\"é", 3, null]'))


def test_numbers_are_spelled_as_content_ids_hash_them(spark):
    numbers = [0.0, 1.0, -2.5, 1e-3, 1.5e-4, 9.99e-5, 1e-10, -3.25e-7, 1e7, 123456789.5, 1.25e15, 1e16, -1.5e22, 1e100, 2 / 3]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert [r.t for r in rows.select(ids.number_text("x").alias("t")).collect()] == [repr(x) for x in numbers]


def spans(spark, text, terms):
    rows = spark.createDataFrame([("k", text)], "key string, text string")
    table = term_table(spark.createDataFrame(terms, "id string, term string"), "id", "term")
    found = match_spans(rows, ["key"], "text", table)
    return sorted((r.identity, r.span_start, r.span_end, r.matched_text) for r in found.collect())


def test_spans(spark):
    nike = [("nike", "Nike"), ("air", "Nike Air")]
    assert spans(spark, "NIKE Air Nikes Nike", nike) == [("air", 0, 8, "NIKE Air"), ("nike", 15, 19, "Nike")]
    assert spans(spark, "Straße", [("s", "STRASSE")]) == [("s", 0, 6, "Straße")]
    cjk = [("short", "耐克"), ("long", "耐克跑鞋")]
    assert spans(spark, "买耐克跑鞋吧", cjk) == [("long", 1, 5, "耐克跑鞋")]
    both = [("a", "Acme"), ("b", "acme")]
    assert [s[0] for s in spans(spark, "acme", both)] == ["a", "b"]
    assert spans(spark, "big & co.", [("x", "& co"), ("y", "&")]) == [("x", 4, 8, "& co")]


def plain_spans(text, terms):
    """All spans by walking the folded text a character at a time, longest first."""
    folded, origin = "", []
    for i, letter in enumerate(text):
        folded += letter.casefold()
        origin += [i] * len(letter.casefold())
    inside = lambda p: 0 <= p < len(folded) and (folded[p].isalnum() or folded[p] == "_")
    found = set()
    for identity, term in terms:
        needle, p = term.strip().casefold(), 0
        while needle and (p := folded.find(needle, p)) >= 0:
            end = p + len(needle)
            if not (inside(p - 1) or inside(end)):
                found.add((identity, origin[p], origin[end - 1] + 1))
            p = end
    kept = []
    for s in sorted(found, key=lambda s: (s[1] - s[2], s[1], s[0])):
        if all(s[1] >= k[2] or k[1] >= s[2] or s[1:] == k[1:] for k in kept):
            kept.append(s)
    return sorted((*s, text[s[1] : s[2]]) for s in kept)


ODD_LETTERS = "İ ß ẞ ﬁ ﬃ ŉ ǰ ΐ ΰ և ẖ ẛ ſ ς Σ σ µ Ꭰ ꭰ Ა Ⱥ Ω K 𐐀 ᾳ ᾼ 𞤀".split()


def test_spans_of_letters_that_fold_long(spark):
    assert spans(spark, "İİ Nike now", [("nike", "nike")]) == [("nike", 3, 7, "Nike")]
    assert spans(spark, "eﬀect ŉ NIKE", [("e", "EFFECT"), ("n", "nike")]) == [("e", 0, 5, "eﬀect"), ("n", 8, 12, "NIKE")]
    rng = random.Random(5)
    terms = [(f"t{i}", " " * (i % 2) + "".join(rng.choices([*ODD_LETTERS, "a", "k", "s"], k=1 + i % 3)) + "\u2003" * (i % 2)) for i in range(20)]
    texts = ["".join(rng.choices([*ODD_LETTERS, " ", " ", "-", "a", "k", "ss", "fi"], k=40)) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    table = term_table(spark.createDataFrame(terms, "id string, term string"), "id", "term")
    got = {}
    for r in match_spans(rows, ["n"], "text", table).collect():
        got.setdefault(r.n, []).append((r.identity, r.span_start, r.span_end, r.matched_text))
    for n, text in enumerate(texts):
        assert sorted(got.get(n, [])) == plain_spans(text, terms), text


def test_every_letter_folds(spark):
    letters = [chr(c) for c in range(1, 0x1FFFF) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c)]
    rows = spark.createDataFrame([(c, f"x{c}y{c}z") for c in letters], "c string, t string")
    for r in rows.select("c", folding("t").alias("f"), fold("t").alias("g")).collect():
        text, extra = fold_with_extra(f"x{r.c}y{r.c}z")
        assert (r.f.folded, r.f.extra, r.g) == (text, extra, text), hex(ord(r.c))


@pytest.mark.parametrize("url,host,canonical", [
    ("https://nike.com:443/a#f", "nike.com", "https://nike.com/a"),
    ("HTTPS://Nike.COM./x", "nike.com", None),
    ("http://nike.com@evil.org/", None, None),
    ("http://a_b.com?q=1", "a_b.com", "http://a_b.com/?q=1"),
    ("https://[::1]:8080/p", "::1", "https://[::1]:8080/p"),
    ("ftp://h/x", None, None),
    ("bare.example", "bare.example", None),
    ("  ", None, None),
])
def test_urls(spark, url, host, canonical):
    assert value(spark, ur.hostname(F.lit(url))) == host
    assert value(spark, ur.canonical_url(F.lit(url))) == canonical


def test_visible_text(spark):
    text = "see [shop](https://x.org/a) or <https://y.net> https://z.net/q now"
    assert value(spark, tx.visible_text(F.lit(text))) == "see shop or   now"
    assert value(spark, tx.label_text(F.lit("[a](/rel) https://x"))) == "a https://x"


def test_json_types_are_never_coerced(spark):
    doc = jsonx.parse(F.lit('{"b":true,"s":"7","i":7,"d":1.0,"n":null,"i":8}'))
    for key, number in {"b": None, "s": None, "i": 8, "d": None, "n": None, "x": None}.items():
        assert value(spark, jsonx.integer(doc, f"$.{key}")) == number
    assert value(spark, jsonx.text(doc, "$.s")) == "7"
    assert value(spark, jsonx.text(doc, "$.i")) is None
    assert value(spark, jsonx.parse(F.lit('{"a":NaN}')).isNull())


@pytest.mark.parametrize("table,text", [
    ('[["a",1],["b",null]]', "a | 1\nb | "), ('[["a"],["b","c"]]', None), ("[]", None), ("[[]]", None),
    ('[[{"x":1}]]', None), ('{"a":1}', None),
])
def test_table_text(spark, table, text):
    assert value(spark, jsonx.table_text(jsonx.parse(F.lit(table)))) == text


def test_placeholder_and_language(spark):
    assert value(spark, tx.is_placeholder(F.lit("示例品牌")))
    assert not value(spark, tx.is_placeholder(F.lit(None).cast("string")))
    assert value(spark, tx.normalize_language(F.lit(" zh_CN "))) == "zh-cn"
    assert value(spark, tx.normalize_language(F.lit(" "))) is None


def test_names_of_ids_and_urls_are_evaluated_once(spark):
    """A costly value under an id or a URL must not be copied into every part of the result."""
    import uuid

    from pyspark.sql import functions as F

    from sightline.functions import ids, url

    urls = {
        "HTTPS://WWW.A.Shop:443/p?x=1#f": None, "https://www.A.shop:443/p?x=1#f": "https://www.a.shop/p?x=1", "http://a.b?": "http://a.b/",
        "http://[::1]:8080/x": "http://[::1]:8080/x", "ftp://h/x": None, "http://u@h/": None, "": None, None: None, "http://h.:70000/": None,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").repartition(1)
    costly = F.reverse(F.reverse("u"))
    found = rows.select("u", ids.uuid5(costly).alias("i"), url.canonical_url(costly).alias("c"), url.hostname(costly).alias("h"))
    for r in found.collect():
        assert r.i == (None if r.u is None else str(uuid.uuid5(uuid.NAMESPACE_URL, r.u)))
        assert r.c == urls[r.u]
    shown = found._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("reverse(reverse(u") == 3


def test_packed_ids_are_small_and_keep_texts_apart(spark):
    from sightline.functions import ids

    one = "0123abcd012341238123012345678900"
    texts = [one, one.upper(), one + "\n", one[:8] + "-" + one[8:], "0" * 32, "0" * 34, "", "\0", "sixteen letters.", None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    packed = {r.n: r.p for r in rows.select("n", ids.packed_hash("t").alias("p")).collect()}
    assert len(packed[0]) == 16 and packed[len(texts) - 1] is None
    assert len({bytes(p) for p in packed.values() if p is not None}) == len(texts) - 1
