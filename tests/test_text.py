"""Text functions on inline rows; expected values follow from the rules by hand."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinara.functions import segment, text
from opinara.functions import fixed_values as V

CLEAN = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("支持[doge]和平！", "支持和平！"),
    ("[a[b]c] x", "ac x"),  # one pass: only the inner pair goes, the outer marks become blanks
    ("看 http://t.cn/abc 了", "看 了"),
    ("看https://t.cn/abc，好", "看"),
    ("@张三 你好 @li_4 hi", "你好 hi"),
    ("【标题】正文《书名》后<b>粗</b>", "正文后粗"),
    ("【未闭合 正文", "未闭合 正文"),
    ("a\n\nb\tc", "a b c"),
    ("<a\nb>", "a b"),
    ("ab😀cd", "abcd"),
    ("ab🤔cd", "ab cd"),
    ("不错~~~good-job!", "不错 good job!"),
    ("停火，谈判。真的？3.5%", "停火，谈判。真的？3.5"),
    ("naïve café_x", "naïve café_x"),
    ("a b", "a b"),
    ("x  y", "x y"),
]


def test_clean_comment(column):
    got = column([a for a, _ in CLEAN], text.clean_comment)
    assert got == [b for _, b in CLEAN]


def test_clean_is_stable_on_its_own_output(column):
    first = column([a for a, _ in CLEAN], text.clean_comment)
    assert column(first, text.clean_comment) == first


def test_normalize_space(column):
    cases = {None: "", "a​b": "ab", " a　b \r\n c\t": "a b c", "a b": "a b", " x ": "x"}
    assert column(list(cases), text.normalize_space) == list(cases.values())


LANGUAGES = [
    ("和平", "zh"),
    ("和", "other"),
    ("和平 abc", "zh"),
    ("和平 abcdefg", "other"),  # 2 < 0.3 * 7 and too few Latin letters
    ("和平和 peace now", "zh"),  # 3 >= 0.3 * 8
    ("和平 peace right now", "en"),  # 2 < 0.3 * 13
    ("peace now", "en"),  # 8 letters, 2 words
    ("peace no", "other"),  # 7 letters
    ("peacenow", "other"),  # one word
    ("a b c d e f g h i j", "other"),
    ("12345 ab 678", "other"),
    ("ab cd ef gh", "en"),
    ("ab cd ef g h", "other"),  # single letters do not count
    ("", "other"),
    (None, "other"),
    ("x peace1now y", "en"),
]


def test_detect_language(column):
    assert column([a for a, _ in LANGUAGES], text.detect_language) == [b for _, b in LANGUAGES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab1 -和", max_size=24), min_size=20, max_size=40))
def test_detect_language_equals_plain_counting(column, values):
    def counted(value):
        runs, run = [], ""
        for ch in value + " ":
            if ch in "ab":
                run += ch
            else:
                if len(run) >= 2:
                    runs.append(run)
                run = ""
        letters, cjk = sum(map(len, runs)), value.count("和")
        if cjk >= 2 and cjk >= letters * 0.3:
            return "zh"
        return "en" if letters >= 8 and len(runs) >= 2 else "other"

    assert column(values, text.detect_language) == [counted(v) for v in values]


def test_detect_language_simple(column):
    cases = {"ok 和": "zh", "It's fine (really).": "en", "naïve": "other", "": "other", "a\nb 1/2": "en", "a*b": "other"}
    assert column(list(cases), text.detect_language_simple) == list(cases.values())


def test_english_tokens(column):
    cases = {
        "The Peace-talks don't stop, don't!": ["peace-talks", "don't", "stop", "don't"],
        "ab'' -abc- it's x--y a'b": ["abc", "it's", "x--y", "a'b"],
        "R2D2 b2bc": [],
        "": [],
        "ENDS' with-": ["ends"],
    }
    got = column(list(cases), lambda c: text.english_tokens(c, ["the", "with"]))
    assert got == list(cases.values())


def test_dictionary_tokens_in_both_paths(column):
    lexicon = {"和平": "n", "和平解决": "n", "支持": "v", "非常": "d", "的": "u", "us": "n", "美": "a", "T恤": "n"}
    cases = {
        "支持和平解决的US us": ["支持", "和平解决", "us"],
        "非常和平美": ["非常", "和平"],  # one-character words go
        "because us2 us": ["us"],
        "买T恤": ["T恤"],
        "": [],
    }
    for in_jvm in (True, False):
        got = column(list(cases), lambda c: segment.dictionary_tokens(c, lexicon, ["他们"], in_jvm=in_jvm))
        assert got == list(cases.values()), in_jvm
        pairs = column(
            list(cases), lambda c: F.transform(segment.segment(c, lexicon, in_jvm), lambda p: F.concat_ws("/", p["word"], p["tag"]))
        )
        assert pairs[0] == ["支持/v", "和平解决/n", "的/u", "US/eng", " /x", "us/n"]
        assert pairs[2] == ["because/eng", " /x", "us2/eng", " /x", "us/n"]


def test_default_segmenter_words(column):
    got = column(["特朗普反战不支持伊朗，和平解决"], lambda c: segment.dictionary_tokens(c, segment.custom_lexicon(), V.ENTITY_WORDS))
    assert got == [["反战", "不支持", "和平解决"]]


def test_tokens_choose_by_language(spark):
    rows = spark.createDataFrame([("en", "support peace"), ("zh", "反战停火"), ("other", "反战 ok")], "language string, t string")
    out = rows.select(segment.tokens(F.col("t"), F.col("language"), segment.custom_lexicon(), ["support"]).alias("w"))
    assert [r["w"] for r in out.collect()] == [["peace"], ["反战", "停火"], ["反战"]]


def test_keep_tagged_by_prefix(spark):
    rows = [([("a", "nr"), ("b", "vn"), ("c", "x"), ("d", "ad"), ("e", "m")],)]
    pairs = spark.createDataFrame(rows, "p array<struct<word:string,tag:string>>")
    kept = pairs.select(text.keep_tagged(F.col("p"), V.KEPT_TAGS).alias("k")).first()["k"]
    assert [r["word"] for r in kept] == ["a", "b", "d"]


def test_stored_tokens(column):
    cases = {
        "['和平', 'peace']": ["和平", "peace"],
        '["don\'t", \'ok\']': ["don't", "ok"],
        "[]": [],
        "a  b c": ["a", "b", "c"],
        "123": None,
        "'abc'": None,
        "None": None,
        None: None,
        "[broken": ["[broken"],
    }
    assert column(list(cases), text.stored_tokens) == list(cases.values())


def test_vector_terms_and_distinct_words(spark):
    row = spark.sql("select array('don''t', 'peace-talks', '和平') t, 'War war DON''T x-' s")
    out = row.select(text.vector_terms(F.col("t")).alias("a"), text.distinct_words(F.col("s")).alias("b")).first()
    assert out["a"] == ["don", "t", "peace", "talks", "和平"]
    assert out["b"] == ["war", "don't", "x-"]


def test_html_unescape(column):
    cases = {"&amp;quot; &#39;x&#x27; &lt;b&gt; &hellip;": "&quot; 'x' <b> …", None: None, "plain": "plain"}
    assert column(list(cases), segment.html_unescape) == list(cases.values())


@pytest.mark.parametrize("words,count", [
    (V.STOPWORDS_ZH, 113), (V.STOPWORDS_EN, 93), (V.CUSTOM_WORDS, 20), (V.ENTITY_WORDS, 104), (V.BOOST_WORDS, 45),
    (V.VAGUE_WORDS, 155), (V.CLOUD_WORDS, 57), (V.POSITIVE_ZH, 22), (V.NEGATIVE_ZH, 23), (V.POSITIVE_EN, 18),
    (V.NEGATIVE_EN, 30), (V.COUNTRY_TERMS, 10), (V.CONFLICT_TERMS, 17),
])
def test_list_sizes(words, count):
    assert len(words) == count


def test_topic_rule_sizes():
    assert [len(k) for _, k in V.TOPIC_RULES] == [10, 13, 15, 8, 14, 18, 12]
