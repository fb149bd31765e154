from __future__ import annotations

import pytest
from conftest import rows

from linetone.sources import as_types, inferred_types, read_inferred

COLUMNS = {
    "small": (["1", "-7", "+3", None], "int"),
    "large": (["1", "3000000000", "2", None], "bigint"),
    "huge": (["1", "123456789012345678901234567890", "2", None], "decimal(38,0)"),
    "real": (["1", "2.5", "-1e3", ".5"], "double"),
    "huge_real": (["123456789012345678901234567890", "1.5", None, "2"], "double"),
    "special": (["NaN", "1", "-Infinity", "Inf"], "double"),
    "flag": (["true", "FALSE", None, "True"], "boolean"),
    "stamp": (["2020-01-02 03:04:05", "2020-01-02T03:04:05.5", None, "1999-12-31 00:00:00"], "timestamp"),
    "bad_stamp": (["2020-13-45 00:00:00", None, None, None], "string"),
    "flag_and_number": (["true", "1", None, None], "string"),
    "text": (["1", "2", "x", None], "string"),
    "blank": ([" 1", "2", "3", None], "string"),
    "nothing": ([None] * 4, "string"),
    "odd.name": (["1", "2", "3", "4"], "int"),
}


@pytest.fixture
def cells(spark):
    schema = ", ".join(f"`{c}` string" for c in COLUMNS)
    return spark.createDataFrame(list(zip(*(v for v, _ in COLUMNS.values()), strict=True)), schema)


def test_types_of_all_cells(cells):
    want = {c: t for c, (_, t) in COLUMNS.items()}
    assert inferred_types(cells) == inferred_types(cells.repartition(3)) == want
    typed = as_types(cells, want)
    assert [t for _, t in typed.dtypes] == list(want.values())
    assert sorted(str(r["special"]) for r in typed.collect()) == ["-inf", "1.0", "inf", "nan"]


def test_an_empty_table_has_strings(cells):
    assert set(inferred_types(cells.limit(0)).values()) == {"string"}


CATALOGUE = """movieId,title,year,score,seen
1,"Heat, The",1995,7.5,true
2,Up,2009,8,false
3,It,1990,6.9,true
"""


def test_catalogue_with_other_columns(spark, tmp_path):
    """As the scan that infers types finds them, here from whole files."""
    path = tmp_path / "movies.csv"
    path.write_text(CATALOGUE)
    found, rejects = read_inferred(spark, str(path), ["movieId"])
    plain = spark.read.csv(str(path), header=True, inferSchema=True)
    assert found.dtypes == plain.dtypes
    assert rows(found) == rows(plain) and rejects.count() == 0


def test_a_late_row_widens_its_column_and_rejects_do_not(spark, tmp_path):
    path = tmp_path / "movies.csv"
    late = "".join(f"{i},t{i},{i},{i},true\n" for i in range(4, 3000))
    path.write_text(CATALOGUE + late + "9000000000,last,n/a,1e400,true\nx,too,few\n,no id,1,1,true\n")
    found, rejects = read_inferred(spark, str(path), ["movieId"])
    assert dict(found.dtypes) == {
        "movieId": "bigint", "title": "string", "year": "string", "score": "double", "seen": "boolean"
    }
    assert found.count() == 3000
    assert {r["rejected_record"] for r in rejects.collect()} == {"x,too,few", None} or rejects.count() == 2


def test_phrases_with_quotes(spark, tmp_path):
    path = tmp_path / "train.tsv"
    path.write_text('PhraseId\tSentenceId\tPhrase\tSentiment\n1\t1\t"open\t2\n2\t1\tplain\t4\n')
    found, _ = read_inferred(spark, str(path), ["PhraseId", "Phrase"], sep="\t", quote="")
    assert [t for _, t in found.dtypes] == ["int", "int", "string", "int"]
    assert rows(found, "Phrase") == [('"open',), ("plain",)]


def test_a_required_column_that_is_not_there(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text("id,name\n1,x\n")
    with pytest.raises(ValueError, match="movieId"):
        read_inferred(spark, str(path), ["movieId"])
