import pytest

from docspark.operators import metadata as M


def fields(spark, raw, **options):
    df = spark.createDataFrame([(1, raw)], "doc_id int, raw_metadata map<string,string>")
    return M.coerce_metadata(df, **options).first()


def test_first_present_key_wins_even_when_empty(spark):
    row = fields(spark, {"dc:title": "", "Title": "later", "dc:creator": "c", "Artist": "a"})
    assert row["metadata"]["title"] is None and row["metadata"]["creator"] == "c"


def test_zero_and_empty_are_null(spark):
    row = fields(spark, {"meta:word-count": "0", "xmpDM:duration": "0.0", "dc:type": ""})
    assert row["metadata"]["word_count"] is None and row["metadata"]["duration"] is None
    assert row["metadata_unparsed"] == {}


@pytest.mark.parametrize(("text", "value"), [("5", 5), (" 7 ", 7), ("1_000", 1000), ("-3", -3), ("12.5", None),
                                             ("many", None), ("1__0", None), ("99999999999999999999", None)])
def test_integers(spark, text, value):
    row = fields(spark, {"meta:page-count": text})
    assert row["metadata"]["page_count"] == value
    assert row["metadata_unparsed"] == ({} if value is not None else {"page_count": text})


@pytest.mark.parametrize(("text", "value"), [("5", 5.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("x", None)])
def test_floats(spark, text, value):
    row = fields(spark, {"xmpDM:duration": text})
    assert row["metadata"]["duration"] == value
    assert row["metadata_unparsed"] == ({} if value is not None else {"duration": text})


def test_lists_booleans_and_first_of_a_list(spark):
    row = fields(spark, {"meta:keyword": " a ,b,, c", "pdf:encrypted": "false", "pdf:charsPerPage": "12",
                         "resource_path": "x"})["metadata"]
    assert row["keywords"] == ["a", "b", "", "c"] and row["is_encrypted"] == "false"
    assert row["chars_per_page"] == 12 and row["resource_path"] is None
    assert len(row) == 61


def test_strict_raises(spark):
    with pytest.raises(Exception, match="PARSE_ERROR"):
        fields(spark, {"meta:word-count": "many"}, strict=True)


def test_selected_text_stays_unconverted(spark):
    df = spark.createDataFrame([({"meta:word-count": "many"},)], "raw_metadata map<string,string>")
    assert M.select_metadata(df).first()["word_count"] == "many"


def test_diff(spark):
    left = spark.createDataFrame([(1, "a", "1"), (1, "b", "2"), (1, "c", None), (1, "skip", "x")],
                                 "doc_id int, key string, value string")
    right = spark.createDataFrame([(1, "a", "1"), (1, "b", "3"), (1, "d", "4"), (1, "c", None)],
                                  "doc_id int, key string, value string")
    rows = sorted(map(tuple, M.metadata_diff(left, right, ignore=["skip"]).collect()))
    assert rows == [(1, "b", "different", "2", "3"), (1, "d", "only_right", None, "4")]


def test_children_get_depth_and_relationship(spark):
    df = spark.createDataFrame([({"k": "v"}, 2, "r1")],
                               "raw_metadata map<string,string>, depth int, relationship_id string")
    raw = M.embedded_metadata(df).first()["raw_metadata"]
    assert raw == {"k": "v", "X-TIKA:embedded_depth": "2", "embeddedRelationshipId": "r1"}
