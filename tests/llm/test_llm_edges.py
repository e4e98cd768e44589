"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenorlake.llm import langid, licenses, linededup, mainhtml, mixing, neardup, packing, quality, secrets, spotsigs, suffixes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i % 83}x{i * 7 % 101}" for i in range(120)]
LONG = " ".join(f"v{i * i % 9973}" for i in range(30_000))
ROWS = [
    (1, " ".join(WORDS), "en", "a", 10),
    (2, " ".join(WORDS), "en", "a", 10),
    (3, "", "en", "b", 0),
    (4, None, "fr", "b", None),
    (5, " \n\t ", None, None, 3),
    (6, LONG, "fr", None, len(LONG)),
    (7, "12 34 !!", "en", "a", 8),
    (8, "one two", None, "c", 7),
    (8, "one two", None, "c", 7),  # the same row twice
    (None, " ".join(WORDS[:60]), "en", "c", 5),
]

OPERATORS = {
    "suffixes": lambda df: suffixes.repeats(df),
    "secrets": lambda df: secrets.scan(df),
    "masked": lambda df: secrets.masked(df).select("doc_id", "text"),
    "neardup": lambda df: neardup.near_duplicates(df),
    "mix": lambda df: mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken"),
    "repeated": lambda df: mixing.repeated(df).select("doc_id", "text"),
    "quality": lambda df: quality.decide(quality.ledger(df)),
    "pack": lambda df: packing.pack(df, TOKENIZER).drop("sequence_id", "offset"),
    "langid": lambda df: langid.identify(df, langid.fitted(df)),
    "spotsigs": lambda df: spotsigs.edited_likeness(df),
    "licenses": lambda df: licenses.scan(df),
    "lines": lambda df: linededup.deduplicated(df),
    "pages": lambda df: mainhtml.extract(df.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))),
}
ONE_ROW_EACH = ("secrets", "masked", "neardup", "mix", "quality", "langid", "spotsigs", "licenses", "lines", "pages")
CLASHES = "words size blob row key cell node component signature set_key start length ids shard lang_pred score taken target source_size edge of whole quota".split()
CLASHES += "w s p bits lines spans kind rule block place tie guest own next_text head class first last begin end role a b fine held_out kept policy n n_words suspected gone keeper repeated n_lines".split()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(odd, name):
    want = rows_of(OPERATORS[name](odd))
    if name in ONE_ROW_EACH:
        assert len(want) == len(ROWS)
    more = odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    assert rows_of(OPERATORS[name](more)) == want


def test_defined_results(odd):
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect()}
    assert near[1, 116][0] == near[2, 116][0] == 1 and near[1, 116][1] and not near[2, 116][1]
    assert near[3, 0] == near[3, 0] and near[4, 0] == (4, True) and near[5, 0] == (5, True)
    assert near[8, 1] == (8, True) and near[None, 56] == (None, True)
    langs = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, langid.fitted(odd)).collect()}
    assert langs[3] == langs[4] == langs[5] == langs[7] == ("und", 0.0)
    prints = {r.doc_id: r for r in spotsigs.edited_likeness(odd).collect()}
    assert prints[1].fingerprint == prints[2].fingerprint and prints[3].fingerprint == prints[4].fingerprint
    assert prints[1].near_next == 1.0
    spans = {(r.doc_id, r.start, r.n_words, r.later_words) for r in suffixes.repeats(odd).where("doc_id < 3").collect()}
    assert spans == {(1, 0, 120, 0), (2, 0, 120, 120)}
    assert {r.doc_id: r.kept for r in quality.decide(quality.ledger(odd)).where("doc_id in (1, 3, 4)").collect()} == {1: True, 3: False, 4: False}


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, odd, stage):
    name, function = corpus_pipeline.STAGES[stage]
    empty = function(spark, spark.createDataFrame([], COLUMNS), "")
    assert empty.count() == 0
    out = function(spark, odd, "")
    if name != "pack":
        assert out.columns == odd.columns and out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
    kept = {r.doc_id for r in out.collect()}
    if name == "language":
        assert {1, 2, 6, 8} <= kept and not kept & {3, 4, 5, 7}
    if name == "near_duplicates":
        assert sorted(r.doc_id for r in out.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7, 8]
    if name in ("secrets", "pack"):
        assert kept == {r[0] for r in ROWS}


def test_pictures_are_no_letters(spark):
    rows = [(i, WORDS_OF[i % 2], ("en", "fr")[i % 2], "a", 1) for i in range(40)]
    rows += [(100, "\U0001f600 \U0001f680", None, "a", 3), (101, "\U00010400\U00010401 the and", None, "a", 3)]
    df = spark.createDataFrame(rows, COLUMNS)
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, langid.fitted(df)).collect()}
    assert found[100] == ("und", 0.0) and found[101][0] == "en"


WORDS_OF = ("the and of in that it was the house", "le la et de que les dans une maison")


def test_different_texts_under_one_id_both_stay(spark):
    one, other = " ".join(WORDS), " ".join(w[::-1] for w in WORDS)
    df = spark.createDataFrame([(1, one, "en", "a", 1), (1, other, "en", "a", 1), (1, other, "en", "a", 1), (2, one, "en", "a", 1)], COLUMNS)
    assert sorted((r.doc_id, r.text) for r in neardup.deduplicated(df).collect()) == sorted([(1, one), (1, other)])


def test_distinct_tokens_need_no_sort_and_no_cleared_places():
    import numpy as np

    from tenorlake.llm import packing

    random, last = np.random.default_rng(3), np.full(packing.VOCABULARY, 5, np.int64)
    for n, most in ((1, 2), (7, 3), (500, 40), (5000, packing.VOCABULARY)):
        ids = random.integers(0, most, n).astype("<u2")
        term, count = packing.counted(ids)
        assert sorted(packing.distinct(ids, last).tolist()) == term.tolist() == np.unique(ids).tolist()
        assert count.tolist() == np.unique(ids, return_counts=True)[1].tolist()
