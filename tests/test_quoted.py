"""CSV files shared by many tasks against the read of whole files by one."""

import random

import pytest

from tableprep.sources import quoted, readers

OPTIONS = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def table(rng, rows, breaks=True):
    """Rows of three fields with quotes, separators and line breaks, and stray quotes in fields that are not quoted."""
    def field():
        kind = rng.random()
        if kind < 0.3:
            return rng.choice(["", "a", 'x" y', "5\"", "é€😀", " lead"])
        body = "".join(rng.choice(["a", " ", ",", '""', "é", "b" * 9] + ["\n", "\n\n"] * breaks) for _ in range(rng.randrange(9)))
        return '"' + body + '"' + rng.choice(["", "", "", "tail"])

    return "".join(",".join(field() for _ in range(3)) + "\n" + ("\n" if rng.random() < 0.1 else "") for _ in range(rows))


def counted(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_as_one_task_reads_it(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for name in "ab":
        end = rng.choice(["", ",,\n", ",,\n,,\n", '"",,\n\n\n'])
        (tmp_path / f"{name}.csv").write_text("k,text,more\n" + table(rng, 60, breaks=name == "a" or seed % 2 == 0) + end, encoding="utf-8")
    one = readers._read_whole(spark, [str(tmp_path)], 304, OPTIONS)
    many = readers.read_header_csv(spark, str(tmp_path))
    assert counted(many) == counted(one) and many.columns == ["k", "text", "more"]
    assert many.rdd.getNumPartitions() > 10


def test_a_record_over_many_splits_and_line_ends(spark, tmp_path, small_splits):
    long = "x\r\n" * 300
    (tmp_path / "a.csv").write_bytes(f'k,"te\r\nxt"\r\n1,"{long}"\r\n2,"{long}y"\r\n3,z\r\n,\r\n'.encode())
    found = readers.read_header_csv(spark, str(tmp_path))
    assert found.columns == ["k", "te\nxt"]
    assert counted(found) == [("1", "x\n" * 300), ("2", "x\n" * 300 + "y"), ("3", "z")]


def test_filters_and_columns_reach_plain_files(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("k,text\n" + "".join(f'{i},"a, ""b"""\n' for i in range(50)))
    found = readers.read_header_csv(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 5 and found.count() == 50
    plan = found.where("k = '7'").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,7)" in plan and "ReadSchema: struct<k:string>" in plan and "InArrow" not in plan


def test_bare_carriage_returns_and_folders_named_after_values(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'k,v\r1,2\r,\r')
    assert counted(readers.read_header_csv(spark, str(tmp_path / "a.csv"))) == [("1", "2")]
    for day in (1, 2):
        (tmp_path / f"t/d={day}").mkdir(parents=True)
        (tmp_path / f"t/d={day}/a.csv").write_text(f'k,v\n{day},"x\ny"\n,\n')
    found = readers.read_header_csv(spark, str(tmp_path / "t"))
    assert counted(found.select("k", "v", "d")) == [("1", "x\ny", 1), ("2", "x\ny", 2)]


def test_another_header_in_a_quoted_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text('v,k\n1,"x\ny"\n')
    with pytest.raises(Exception, match="another header"):
        readers.read_header_csv(spark, str(tmp_path)).collect()


def test_states_of_lines():
    for line, ends in {"a,b": (0, 1), 'a,"b': (1, 0), '"': (1, 0), '5" pipe,"': (1, 1), 'a"b': (0, 0), '"a""': (1, 0), '"",': (0, 1), "": (0, 1),
                       '"q"x,"y"': (0, 0), '",",': (0, 1)}.items():
        found = tuple(quoted.state_after(line, state) for state in (0, 1))
        assert found == ends, (line, found)
    assert quoted.state_after('"' + '""' * 500_000, 0) == 1 and quoted.state_after('a,' * 500_000 + '"', 0) == 1
