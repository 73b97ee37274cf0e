"""CSV dialects, types, names and the one-file sink."""

import datetime as dt

import pytest

from kiln.sources import catalog, csv
from kiln.sources.csv import read_csv, sniff, unique_names, write_csv


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_delimiters(spark, tmp_path, sep):
    path = put(tmp_path / "a.csv", "id,x,y\n1,2.5,\"a b\"\n2,,c\n".replace(",", sep))
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [(1, 2.5, "a b"), (2, None, "c")]


def test_single_column_and_quotes(spark, tmp_path):
    assert read_csv(spark, put(tmp_path / "a.csv", "customer_id\n7\n8\n")).columns == ["customer_id"]
    assert sniff('"a;b;c",d') == ","


def test_types(spark, tmp_path):
    text = "i,n,f,b,d,s,big,inf,lead,nul,exp\n1,NA,1.5,True,2024-01-01,x,99999999999999999999,inf,007,null,1e3\n2,5,2,false,2024-02-01,1,1,2,8,#N/A,2\n"
    df = read_csv(spark, put(tmp_path / "a.csv", text))
    assert dict(df.dtypes) == {"i": "bigint", "n": "bigint", "f": "double", "b": "boolean", "d": "date", "s": "string", "big": "double", "inf": "double", "lead": "bigint", "nul": "double", "exp": "double"}
    first = df.first()
    assert first.n is None and first.b is True and first.d == dt.date(2024, 1, 1) and first.inf == float("inf") and first.lead == 7 and first.exp == 1000.0


def test_names_and_row_lengths(spark, tmp_path):
    assert unique_names(["ft", "ft", "", "A", "a"]) == ["ft", "ft.1", "Unnamed: 2", "A", "a"]
    short = read_csv(spark, put(tmp_path / "s.csv", "a,b\n1\n\n2,3\n"))
    assert sorted(map(tuple, short.collect())) == [(1, None), (2, 3)]
    with pytest.raises(ValueError, match="more fields"):
        read_csv(spark, put(tmp_path / "l.csv", "a,b\n1,2,3\n"))
    with pytest.raises(ValueError, match="empty"):
        read_csv(spark, put(tmp_path / "e.csv", ""))


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "q", x', True, None), (2, None, False, 0.5)], "id long, s string, b boolean, x double")
    for _ in range(2):  # the second replaces the first
        write_csv(df.repartition(3), str(tmp_path / "out.csv"))
    lines = (tmp_path / "out.csv").read_text().splitlines()
    assert lines[0] == "id,s,b,x" and '1,"say ""q"", x",True,' in lines
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "out.csv")).collect())) == sorted(map(tuple, df.collect()))


def test_catalog_and_project_files(spark, tmp_path):
    put(tmp_path / "t.csv", "a\n1\n")
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    found = catalog.TableCatalog(spark, str(tmp_path))
    assert list(found) == ["p", "t"] and found["p"].count() == 3 and found["t"].count() == 1
    with pytest.raises(FileNotFoundError):
        found["none"]
    deps = catalog.dependencies('[project]\ndependencies = ["Pandas>=2", "catboost"]')
    assert deps == ["pandas>=2", "catboost"] and catalog.missing_dependencies(deps, ["pandas", "scikit"]) == ["scikit"]
    with pytest.raises(TypeError):
        catalog.dependencies('[project]\ndependencies = "x"')
    assert catalog.has_setting("A=1\nKEY=2", "KEY") and not catalog.has_setting("A=1", "KEY")


def test_rows_of_one_line_and_of_several(spark, tmp_path):
    plain, broken, blank = tmp_path / "plain.csv", tmp_path / "broken.csv", tmp_path / "blank.csv"
    plain.write_text('a,b\n1,"say ""hi"", you"\n2,"x"\n')
    broken.write_text('a,b\n1,"two\nlines"\n2,x\n')
    blank.write_text("a\tb\n1\tx\n\t\n2\ty\n")
    assert csv.one_line_rows(spark, str(plain)) and not csv.one_line_rows(spark, str(broken)) and not csv.one_line_rows(spark, str(blank))
    assert sorted(map(tuple, csv.read_csv(spark, str(plain)).collect())) == [(1, 'say "hi", you'), (2, "x")]
    assert sorted(map(tuple, csv.read_csv(spark, str(broken)).collect())) == [(1, "two\nlines"), (2, "x")]
    assert csv.read_csv(spark, str(blank)).count() == 3
