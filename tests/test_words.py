import random

import pytest
import regex
from conftest import rows
from samples import LINES, WORD_COUNTS

from tidemark.functions import codecs
from tidemark.operators.stateless import tokenize
from tidemark.plans import word_count
from tidemark.streaming import sinks


@pytest.mark.parametrize(
    ("text", "words"),
    [
        (" hello", ["", "hello"]),
        ("", [""]),
        ("!!!", []),
        (" ", []),
        ("a b ", ["a", "b"]),
        ("a--b!?", ["a", "b"]),
        ("...a", ["", "a"]),
        ("one", ["one"]),
        ("snake_case 42", ["snake_case", "42"]),
        ("Zażółć GĘŚLĄ-jaźń", ["zażółć", "gęślą", "jaźń"]),
        ("日本語 テスト", ["日本語", "テスト"]),
        ("line one\nline\ttwo", ["line", "one", "line", "two"]),
        (None, []),
    ],
)
def test_words_of_a_line(spark, text, words):
    df = spark.createDataFrame([(text,)], "value string")
    found = tokenize(df).orderBy("pos").collect()
    assert [r.word for r in found] == words
    assert [r.pos for r in found] == list(range(len(words)))


def test_words_of_random_texts(spark):
    """Against an independent splitter; the alphabet mixes scripts, marks and delimiters."""
    draw = random.Random(3)
    alphabet = "aB_9 -!żŁß日\u0301\u200d٣Ⅷé.\n\u00a0"
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(12))) for _ in range(600)]
    delimiter = regex.compile(r"[^\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\p{Join_Control}]+")
    wanted = []
    for i, text in enumerate(texts):
        words = delimiter.split(text.lower())
        while len(words) > 1 and words[-1] == "" or (words == [""] and text != ""):
            words.pop()
        wanted += [(i, pos, word) for pos, word in enumerate(words)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    assert rows(tokenize(df, keep=["id"]), "id", "pos", "word") == sorted(wanted, key=repr)


@pytest.fixture
def lines(spark):
    records = [(line, 0, i) for i, line in enumerate(LINES)]
    return spark.createDataFrame(records, "value string, partition int, offset long")


def test_counts(lines):
    assert dict(rows(word_count.counts(lines))) == WORD_COUNTS


def test_count_changes_have_one_row_per_word_read(lines):
    changes = word_count.count_changes(lines)
    found = rows(changes, "key", "value")
    assert len(found) == 11
    assert [v for k, v in found if k == "kafka"] == [1, 2, 3]
    assert [v for k, v in found if k == "streams"] == [1, 2]


def test_empty_words_are_counted(spark):
    df = spark.createDataFrame([(" x",), ("",), ("?y",), ("!!",)], "value string")
    assert dict(rows(word_count.counts(df))) == {"": 3, "x": 1, "y": 1}


def test_count_messages_hold_eight_byte_counts(lines):
    sent = sinks.long_messages(word_count.counts(lines))
    found = {r.key: bytes(r.value) for r in sent.collect()}
    assert found["kafka"] == (3).to_bytes(8, "big")


@pytest.mark.parametrize("number", [0, 1, -1, 255, 2**62, -(2**63), 2**63 - 1])
def test_longs_survive_the_binary_form(spark, number):
    df = spark.createDataFrame([(number,)], "n long")
    packed = df.select(codecs.long_to_bytes(df.n).alias("b"))
    assert bytes(packed.first().b) == number.to_bytes(8, "big", signed=True)
    assert packed.select(codecs.bytes_to_long(packed.b).alias("n")).first().n == number
