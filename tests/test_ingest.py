import pytest
from pyspark.sql import functions as F

from casebook.session import COMPILED_METHOD_BYTES, METHOD_LIMIT, compiled_methods
from casebook.sources.csv import RAW_LINE, ROW_STATE, MissingInput, load_csv, require_paths
from casebook.sources.specs import ARRESTS, CRIMES, DATASETS, OFFENDERS, STATIONS, VIOLENCE, DatasetSpec

SIMPLE = DatasetSpec("simple", "simple.csv", ("A A", "B-B", "C.C"))


@pytest.fixture
def file(tmp_path):
    def write(text, name="input.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def rows(loaded, *columns):
    return sorted((tuple(r) for r in loaded.rows.select(*columns).collect()), key=repr)


def test_widths_of_the_datasets():
    assert [len(spec.headers) for spec in DATASETS] == [22, 24, 15, 38, 9]
    assert ARRESTS.columns[4] == "charge_1_statute" and ARRESTS.columns[-1] == "charges_class"
    for spec in DATASETS:
        assert set(spec.required) <= set(spec.columns)
        assert {spec.reads.get(c, c) for c in spec.conversions} <= set(spec.columns)


def test_quotes_and_line_breaks(spark, file):
    path = file('A A,B-B,C.C\n1,"12 Example Ave\n","he said ""hi"""\n2,"a,b",c\n')
    loaded = load_csv(spark, path, SIMPLE)
    assert loaded.rows.columns == ["a_a", "b_b", "cc"]
    assert rows(loaded, "a_a", "b_b", "cc") == [("1", "12 Example Ave\n", 'he said "hi"'), ("2", "a,b", "c")]


def test_closed_quotes_keep_the_file_splittable(spark, file):
    path = file('A A,B-B,C.C\n1,"he said ""hi""","x,y"\n')
    assert rows(load_csv(spark, path, SIMPLE), "b_b", "cc") == [('he said "hi"', "x,y")]


def test_line_and_record_parsing_agree(spark, file):
    """The same rows, once in a file of single lines and once beside a record over two lines."""
    text = 'A A,B-B,C.C\n1,"x",\n,,\n2,5"9\' 6"1,z\n" 3 ",N/A,"q ""w"" e"\n'
    plain = rows(load_csv(spark, file(text), SIMPLE), "a_a", "b_b", "cc")
    beside = rows(load_csv(spark, file(text + '4,"x\ny",z\n', "broken.csv"), SIMPLE), "a_a", "b_b", "cc")
    assert beside == sorted([*plain, ("4", "x\ny", "z")], key=repr)


def test_unclosed_quote_swallows_nothing(spark, file):
    body = [f"{i},b{i},x" for i in range(1, 1001)]
    body[499] = '500,"5 in pipe,x'
    loaded = load_csv(spark, file("A A,B-B,C.C\n" + "\n".join(body) + "\n"), SIMPLE)
    assert loaded.profile["rows_in"] == loaded.profile["kept"] == 1000
    assert [r[0] for r in loaded.malformed.select(RAW_LINE).collect()] == ['500,"5 in pipe,x']
    assert {r[0] for r in loaded.rows.select("a_a").collect()} == {str(i) for i in range(1, 1001)}


def test_unclosed_quotes_between_records_over_lines(spark, file):
    path = file('A A,B-B,C.C\n1,"a\n\nb",x\n2,"5 in,x\n3,c,y\n4,"d\ne",z\n5,f,"g\n6,"h",i\n7,"j\n')
    loaded = load_csv(spark, path, SIMPLE)
    found = {r[0]: r[1] for r in loaded.rows.select("a_a", "b_b").collect()}
    assert set(found) == {"1", "2", "3", "4", "5", "6", "7"}
    assert found["1"] == "a\n\nb" and found["4"] == "d\ne" and found["6"] == "h"
    assert {r[0] for r in loaded.malformed.select(RAW_LINE).collect()} == {'2,"5 in,x', '5,f,"g', '7,"j'}


def test_breaks_only_in_declared_columns(spark, file):
    path = file('A A,B-B,C.C\n1,"a\nb",x\n2,c,"d\ne"\n')
    spec = DatasetSpec("simple", "simple.csv", SIMPLE.headers, breaks=("B-B",))
    loaded = load_csv(spark, path, spec)
    assert {r[0] for r in loaded.malformed.select(RAW_LINE).collect()} == {'2,c,"d', 'e"'}
    assert ("1", "a\nb") in {tuple(r) for r in loaded.rows.select("a_a", "b_b").collect()}


def test_files_are_judged_one_by_one(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("A A,B-B,C.C\n" + f"{i},y,z\n" * 20)
    (tmp_path / "open.csv").write_text('A A,B-B,C.C\n9,"x\ny",z\n8,"unclosed,z\n7,a,b\n')
    loaded = load_csv(spark, str(tmp_path), SIMPLE)
    assert loaded.profile["kept"] == 63 and loaded.profile["malformed"] == 1


def test_empty_rows_and_no_value_rows(spark, file):
    loaded = load_csv(spark, file("A A,B-B,C.C\n,,\nN/A,none,None\n"), SIMPLE)
    assert rows(loaded, "a_a", "b_b", "cc") == [(None, "none", None)]
    assert loaded.profile == {"rows_in": 2, "all_null": 1, "missing_required": 0, "kept": 1, "malformed": 0}
    assert {(r.measure, r.rows) for r in loaded.profile_table().collect()} == set(loaded.profile.items())


def test_malformed_rows_are_kept_and_quarantined(spark, file):
    loaded = load_csv(spark, file("A A,B-B,C.C\n1,2,3\n1,2\n1,2,3,4\n"), SIMPLE)
    assert rows(loaded, "a_a", "b_b", "cc") == [("1", "2", "3"), ("1", "2", "3"), ("1", "2", None)]
    assert {r[0] for r in loaded.malformed.select(RAW_LINE).collect()} == {"1,2", "1,2,3,4"}
    assert loaded.malformed.count() == loaded.profile["malformed"] == 2


def test_columns_bind_by_position_unless_strict(spark, file):
    path = file("X,Y,Z\n1,2,3\n")
    assert rows(load_csv(spark, path, SIMPLE), "a_a", "cc") == [("1", "3")]
    with pytest.raises(Exception, match="header does not conform"):
        load_csv(spark, path, SIMPLE, strict_header=True)
    right = file("A A,B-B,C.C\n1,2,3\n", "right.csv")
    assert rows(load_csv(spark, right, SIMPLE, strict_header=True), "a_a") == [("1",)]


def test_every_missing_input_is_named(spark, file):
    present = file("A\n1\n")
    with pytest.raises(MissingInput) as error:
        require_paths(spark, [present, present + ".one", present + ".two"])
    assert ".one" in str(error.value) and ".two" in str(error.value)
    with pytest.raises(MissingInput):
        load_csv(spark, present + ".one", SIMPLE)


def lines(spec, *records):
    """CSV text with the spec's header; records map column names to values."""
    body = [",".join(r.get(c, "") for c in spec.columns) for r in records]
    return "\n".join([",".join(spec.headers), *body]) + "\n"


def test_crimes(spark, file):
    path = file(
        lines(
            CRIMES,
            {"id": "1", "case_number": "A1", "district": "018", "date": "01/03/2021 12:30:00 AM", "arrest": "TRUE",
             "domestic": "yes", "year": "", "latitude": "41.9", "ward": "x"},
            {"id": "2", "case_number": "A2", "district": "abc", "date": "01/05/2021 01:00:00 PM"},
            {"id": "3", "case_number": "A3", "district": "12.7"},
            {"id": "4", "case_number": " ", "district": "3"},
            {"id": "5", "case_number": "A5", "district": "3", "date": "1/5/2021 2:30:00 AM", "year": "1999"},
        )
    )
    loaded = load_csv(spark, path, CRIMES)
    assert rows(
        loaded, "id", "district", F.col("date").cast("string"), "arrest", "domestic", "year", "month", "hour",
        "day_of_week", "latitude", "ward",
    ) == [
        (1, 18, "2021-01-03 00:30:00", True, False, 2021, 1, 0, 1, 41.9, None),
        (5, 3, None, False, False, 1999, None, None, None, None, None),
    ]
    assert dict(loaded.rows.dtypes)["date"] == "timestamp"
    profile = loaded.profile
    assert (profile["rows_in"], profile["missing_required"], profile["kept"]) == (5, 3, 2)
    assert (profile["unread_district"], profile["unread_ward"], profile["unread_date"], profile["unread_arrest"]) == (2, 1, 1, 0)
    assert loaded.rows.columns == [*CRIMES.columns, "month", "hour", "day_of_week"]


def test_arrests(spark, file):
    path = file(lines(ARRESTS, {"case_number": "A1", "race": " white hispanic "}, {"race": "BLACK"}))
    assert rows(load_csv(spark, path, ARRESTS), "case_number", "race") == [("A1", "WHITE HISPANIC")]


def test_stations(spark, file):
    path = file(
        lines(
            STATIONS,
            {"district": "Headquarters", "zip": "00601", "address": '"12 Example Ave\n"'},
            {"district": "18", "latitude": "41.8"},
            {"district": "x"},
        )
    )
    assert rows(load_csv(spark, path, STATIONS), "district", "district_clean", "zip", "address", "latitude") == [
        ("18", 18, None, None, 41.8),
        ("Headquarters", 0, "00601", "12 Example Ave\n", None),
        ("x", None, None, None, None),
    ]


def test_violence(spark, file):
    path = file(
        lines(
            VIOLENCE,
            {"case_number": "V1", "district": "3", "gunshot_injury_i": "yes", "month": "12", "hour": "23", "age": "20-29",
             "zip_code": "06060"},
            {"district": "3"},
        )
    )
    loaded = load_csv(spark, path, VIOLENCE)
    assert rows(loaded, "case_number", "gunshot_injury_i", "month", "hour", "age", "zip_code") == [
        ("V1", True, 12, 23, None, "06060")
    ]
    assert loaded.profile["unread_age"] == 1


def test_offenders(spark, file):
    path = file(
        lines(
            OFFENDERS,
            {"last": "x", "gender": "male", "race": " white", "birth_date": "02/29/1980", "height": "509",
             "weight": "180", "victim_minor": "y"},
            {"last": "y", "height": "5'9", "weight": "heavy", "victim_minor": "N"},
        )
    )
    loaded = load_csv(spark, path, OFFENDERS)
    assert rows(
        loaded, "last", "gender", "race", F.col("birth_date").cast("string"), "height_inches", "weight", "victim_minor"
    ) == [("x", "MALE", "WHITE", "1980-02-29", 69, 180, True), ("y", None, None, None, None, None, False)]
    assert loaded.profile["unread_height_inches"] == loaded.profile["unread_weight"] == 1


def test_states_are_staged(spark, file, tmp_path):
    stage = str(tmp_path / "stage")
    load_csv(spark, file("A A,B-B,C.C\n,,\n1,2,3\n"), SIMPLE, stage=stage)
    states = spark.read.parquet(stage).groupBy(ROW_STATE).count().collect()
    assert {r[0]: r[1] for r in states} == {"all_null": 1, "kept": 1}


def test_wide_files_are_staged_in_compiled_code(spark):
    """The limit holds while the table is written, and the session's own setting comes back."""
    before = spark.conf.get(METHOD_LIMIT)
    with compiled_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == COMPILED_METHOD_BYTES
    assert spark.conf.get(METHOD_LIMIT) == before
    with pytest.raises(ZeroDivisionError), compiled_methods(spark):
        1 / 0
    assert spark.conf.get(METHOD_LIMIT) == before
