import json

import pytest
from conftest import rows

from tidemark.functions import avro, codecs
from tidemark.functions.records import MOVIE, RATED_MOVIE, RATING, TICKET_SALE, avro_schema


ACCEPTED = [
    ('{"title":"A","salets":"x","tickettotalvalue":5}', "A", 5),
    ('{"title":"A"}', "A", 0),
    ('{"tickettotalvalue":5}', None, 5),
    ("{}", None, 0),
    ('{"title":null,"tickettotalvalue":null}', None, 0),
    ('{"tickettotalvalue":"12"}', None, 12),
    ('{"tickettotalvalue":" 12 "}', None, 12),
    ('{"tickettotalvalue":""}', None, 0),
    ('{"tickettotalvalue":2.7}', None, 2),
    ('{"tickettotalvalue":-2.7}', None, -2),
    ('{"tickettotalvalue":1e3}', None, 1000),
    ('{"tickettotalvalue":0}', None, 0),
    ('{"tickettotalvalue":1}', None, 1),
    ('{"tickettotalvalue":9223372036854775807}', None, 2**63 - 1),
    ('{"title":7}', "7", 0),
    ('{"title":true}', "true", 0),
    ('{"title":"{not nested"}', "{not nested", 0),
    ('{"title":"[1]"}', "[1]", 0),
    ('{"title":"A","title":"B"}', "B", 0),
]

REJECTED = [
    ('{"title":"A","tickettotalvalue":5,"extra":1}', codecs.UNKNOWN_FIELD),
    ("bad", codecs.MALFORMED),
    ('{"title":', codecs.MALFORMED),
    ("", codecs.MALFORMED),
    (None, codecs.MALFORMED),
    ("null", codecs.MALFORMED),
    ('[{"title":"A"}]', codecs.MALFORMED),
    ("5", codecs.MALFORMED),
    ('{"tickettotalvalue":"abc"}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":"2.7"}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":true}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":false}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":{"a":1}}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":[1]}', codecs.BAD_FIELD),
    ('{"tickettotalvalue":12345678901234567890}', codecs.BAD_FIELD),
    ('{"title":{"a":1}}', codecs.BAD_FIELD),
    ('{"title":["A"]}', codecs.BAD_FIELD),
]


def decode(spark, text, schema=TICKET_SALE):
    df = spark.createDataFrame([(text,)], "value string")
    return codecs.decode(df, schema).first()


@pytest.fixture(scope="module")
def decoded(spark):
    """All the texts above, decoded in one go."""
    texts = [(case[0],) for case in ACCEPTED + REJECTED]
    df = spark.createDataFrame(texts, "value string")
    return {r.value: r for r in codecs.decode(df, TICKET_SALE).collect()}


@pytest.mark.parametrize(("text", "title", "amount"), ACCEPTED)
def test_accepted(decoded, text, title, amount):
    found = decoded[text]
    assert found.reject_reason is None
    assert (found.decoded.title, found.decoded.tickettotalvalue) == (title, amount)


@pytest.mark.parametrize(("text", "reason"), REJECTED)
def test_rejected(decoded, text, reason):
    found = decoded[text]
    assert found.reject_reason == reason
    assert found.decoded is None


def test_numbers_of_other_widths(spark):
    assert decode(spark, '{"id":1,"rating":"8.5"}', RATING).decoded.rating == 8.5
    assert decode(spark, '{"id":1,"rating":8}', RATING).decoded.rating == 8.0
    assert decode(spark, '{"id":1}', RATING).decoded.rating == 0.0
    assert decode(spark, '{"releaseyear":3000000000}', MOVIE).reject_reason == codecs.BAD_FIELD


def test_every_record_is_either_accepted_or_quarantined(spark):
    texts = ['{"title":"A"}', "bad", None, '{"x":1}']
    decoded = codecs.decode(spark.createDataFrame([(t,) for t in texts], "value string"), TICKET_SALE)
    good, bad = codecs.accepted(decoded), codecs.quarantined(decoded)
    assert rows(good, "value") == [('{"title":"A"}',)]
    assert rows(bad, "value") == sorted([("bad",), (None,), ('{"x":1}',)], key=repr)


def test_encoding_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(1, None, 1999, 8.5)], RATED_MOVIE)
    text = df.select(codecs.encode(*RATED_MOVIE.fieldNames()).alias("v")).first().v
    assert text == '{"id":1,"title":null,"releaseyear":1999,"rating":8.5}'


def test_what_is_encoded_decodes_again(spark):
    movies = [(1, 'quo"te', 1999, 8.5), (2, "ü\n", -1, 0.0), (-3, "", 0, 1e-7)]
    df = spark.createDataFrame(movies, RATED_MOVIE)
    sent = df.select(codecs.encode(*RATED_MOVIE.fieldNames()).alias("value"))
    back = codecs.accepted(codecs.decode(sent, RATED_MOVIE)).select("decoded.*")
    assert rows(back) == sorted(movies, key=repr)


def test_parsing_is_not_repeated_by_a_filter(spark):
    df = codecs.accepted(codecs.decode(spark.createDataFrame([("{}",)], "value string"), TICKET_SALE))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_avro_schema_text():
    found = json.loads(avro_schema(RATED_MOVIE, "RatedMovie", "demo"))
    assert found["type"] == "record"
    assert [(f["name"], f["type"]) for f in found["fields"]] == [
        ("id", "long"),
        ("title", "string"),
        ("releaseyear", "int"),
        ("rating", "double"),
    ]


def test_frame_of_a_registry_value_is_cut_off(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07body"),)], "v binary")
    assert bytes(df.select(avro.unframed(df.v).alias("v")).first().v) == b"body"


def test_numbers_in_text_fields_keep_their_digits_and_repeated_fields_their_last_value(spark):
    long = "1234567890" * 5
    values = {
        '{"title":1.50}': "1.50",
        '{"title":1e2}': "1e2",
        f'{{"title":{long}}}': long,
        '{"salets":"\\"title\\":7","title" : -0.10}': "-0.10",
        '{"title":"a","title":"b"}': "b",
        '{"title":"5"}': "5",
        '{"title":true}': "true",
    }
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    df = spark.createDataFrame([(v,) for v in values], "value string")
    found = codecs.accepted(codecs.decode(df, TICKET_SALE)).select("value", "decoded.title").collect()
    assert {r["value"]: r["title"] for r in found} == values
