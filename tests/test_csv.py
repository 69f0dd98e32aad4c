import csv
import random

import pytest

from freshet.sources import csv_records
from freshet.sources.csv_records import ORDINAL, MissingInputs, read_csv, require_inputs
from records import plan_text


def python_rows(path):
    """The rows Python's csv module reads, numbered; extra fields left out."""
    with open(path, newline="", encoding="utf-8") as f:
        rows = []
        for number, row in enumerate(csv.DictReader(f)):
            row.pop(None, None)
            rows.append((number, *row.values()))
        return rows


def spark_rows(spark, path, names, **options):
    rows = read_csv(spark, str(path), **options).select(ORDINAL, *names).collect()
    return sorted(tuple(row) for row in rows)


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return path


@pytest.fixture
def small_blocks(spark, monkeypatch):
    """Cut files into blocks of some 400 bytes, and those into chunks of 8 lines."""
    monkeypatch.setattr(csv_records, "CHUNK_BITS", 3)
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


EDGES = (
    "a,b,c\r\n"
    '1,"quoted ""word""","x,y"\r\n'
    '2,"two\nlines","and\r\n\r\nfour"\r\n'
    "3,,\r\n"
    "\r\n"
    "4,short\r\n"
    "5,,in short\r\n"
    "6\r\n"
    "7,,x,long,row\r\n"
    '8,"",  padded  \r\n'
    ",,\r\n"
    '9,"a,b",\r\n'
    '10,"x ""y"", z"\r\n'
    '11,é,"ão\n"\r\n'
    "   \r\n"
    '12,5" pipe,ok\r\n'
    '13,"last, no newline at the end",z'
)


def test_edges_equal_pythons_reader(spark, tmp_path, small_blocks):
    path = write(tmp_path / "edges.csv", EDGES)
    expected = python_rows(path)
    assert len(expected) == 15
    assert spark_rows(spark, path, "abc") == expected


@pytest.mark.parametrize("seed", range(6))
def test_random_files_equal_pythons_reader(spark, tmp_path, small_blocks, seed):
    rnd = random.Random(seed)
    pieces = ["a", "é", " ", "x y", ",", '"', '""', '"q"', ',"', "\n", "\r\n"]
    lines = ["h1,h2,h3"]
    for _ in range(rnd.randint(60, 150)):
        if rnd.random() < 0.05:
            lines.append("")
            continue
        fields = []
        for _ in range(rnd.choice([3, 3, 3, 3, 1, 2, 5])):
            text = "".join(rnd.choices(pieces, k=rnd.randint(0, 6)))
            if any(c in text for c in ',"\r\n') or rnd.random() < 0.2:
                text = '"' + text.replace('"', '""') + '"'
            fields.append(text)
        lines.append(",".join(fields))
    ending = rnd.choice(["\n", "\r\n"])
    path = write(tmp_path / "random.csv", ending.join(lines) + rnd.choice(["", ending]))
    assert spark_rows(spark, path, ["h1", "h2", "h3"]) == python_rows(path)


def test_record_spanning_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i} with ""quotes"", commas' for i in range(100))
    path = write(tmp_path / "long.csv", f'a,b\n1,x\n2,"{long}"\n3,y\n' + "4,z\n" * 50)
    assert spark_rows(spark, path, "ab") == python_rows(path)


@pytest.mark.parametrize("broadcast_chunks", [100_000, 0])
def test_ordinals_follow_file_order_over_many_blocks(
    spark, tmp_path, small_blocks, monkeypatch, broadcast_chunks
):
    monkeypatch.setattr(csv_records, "BROADCAST_CHUNKS", broadcast_chunks)
    text = "id,t\n" + "".join(f"{i},some text {i}\n" for i in range(2000))
    path = write(tmp_path / "plain.csv", text)
    rows = spark_rows(spark, path, ["id"])
    assert rows == [(i, str(i)) for i in range(2000)]


def test_files_of_a_folder_are_numbered_apart(spark, tmp_path):
    for name in "pq":
        write(tmp_path / f"{name}.csv", "id\n" + "".join(f"{name}{i}\n" for i in range(3)))
    rows = spark_rows(spark, tmp_path, ["id"])
    assert rows == [(i, f"{name}{i}") for i in range(3) for name in "pq"]


def test_no_shuffle_of_rows_without_spanning_records(spark, tmp_path):
    path = write(tmp_path / "plain.csv", "a,b\n1,x\n2,y\n")
    plan = plan_text(read_csv(spark, str(path)))
    rows_side = plan[: plan.index("BroadcastExchange")]
    assert "Exchange" not in rows_side and "BroadcastHashJoin" in rows_side


@pytest.mark.parametrize("text", ["a,b\n1,x\n2,y\n", "a,b\n\n1,x\n\n\n2,y\n\n"])
def test_an_input_is_staged_once(spark, tmp_path, monkeypatch, text):
    staged = []
    real = csv_records.scratch_dir
    monkeypatch.setattr(
        csv_records, "scratch_dir", lambda *args: staged.append(real(*args)) or staged[-1]
    )
    path = write(tmp_path / "blanks.csv", text)
    assert spark_rows(spark, path, "ab") == python_rows(path)
    assert len(staged) == 1


def test_blank_lines_count_in_their_own_chunks_only(spark, tmp_path, small_blocks):
    text = "a,b\n" + "".join(f"{i},x\n" + "\n" * (i % 40 == 7) for i in range(300))
    path = write(tmp_path / "blanks.csv", text)
    assert spark_rows(spark, path, "ab") == python_rows(path)


@pytest.mark.parametrize("count", [2, 200])
def test_unclosed_quote_is_refused_at_any_size(spark, tmp_path, small_blocks, count):
    lines = "\n".join(f"{i},text" for i in range(count))
    path = write(tmp_path / "unclosed.csv", f'a,b\n1,"never closed\n{lines}')
    with pytest.raises(Exception, match="never closed in"):
        spark_rows(spark, path, "ab")


@pytest.mark.parametrize("row", ['1,"x"y', '"p" ,2', '"a""b"c,2', '""x,2', '1,"a, ""b"" c"d'])
def test_text_after_a_closing_quote_is_refused(spark, tmp_path, row):
    path = write(tmp_path / "after.csv", f"a,b\n0,fine\n{row}\n")
    with pytest.raises(Exception, match="text after a closing quote"):
        spark_rows(spark, path, "ab")


def test_headers_that_differ_in_case_only_are_refused(spark, tmp_path):
    path = write(tmp_path / "case.csv", "id,ID\n1,2\n")
    with pytest.raises(ValueError, match="case only"):
        read_csv(spark, str(path))


def test_stray_quotes_do_not_join_lines(spark, tmp_path):
    path = write(tmp_path / "stray.csv", 'a,b\n1,5" pipe\n2,6" pipe\n')
    assert spark_rows(spark, path, "ab") == python_rows(path)


def test_lines_may_be_declared_records(spark, tmp_path):
    path = write(tmp_path / "broken.csv", 'a,b\n1,"open\n2,x\n')
    rows = spark_rows(spark, path, "a", quoted_newlines=False)
    assert rows == [(0, "1"), (1, "2")]


def test_repeated_header_name_takes_its_last_column(spark, tmp_path):
    path = write(tmp_path / "twice.csv", "a,b,a\n1,2,3\n")
    assert spark_rows(spark, path, "ab") == [(0, "3", "2")]


def test_empty_file_has_no_rows(spark, tmp_path):
    assert read_csv(spark, str(write(tmp_path / "empty.csv", ""))).collect() == []


def test_header_only_file_has_no_rows(spark, tmp_path):
    rows = read_csv(spark, str(write(tmp_path / "header.csv", "a,b\n")))
    assert rows.columns[:2] == ["a", "b"] and rows.collect() == []


def test_differing_headers_are_refused(spark, tmp_path):
    write(tmp_path / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "2.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers"):
        read_csv(spark, str(tmp_path))


def test_all_missing_inputs_are_named(spark, tmp_path):
    here = write(tmp_path / "here.csv", "a\n")
    absent = [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")]
    with pytest.raises(MissingInputs) as error:
        require_inputs(spark, [absent[0], str(here), absent[1]])
    assert error.value.paths == absent
    assert all(path in str(error.value) for path in absent)
    require_inputs(spark, [str(here)])


RETURNS = (
    "a,b,c\r"
    "1,x,y\r"
    '2,"one\rfield","two\r\nends"\r\n'
    "\r"
    "3,,\n"
    '4,"\r","\n"\r'
    '5,"quoted ""word""\r\r",z\n'
    "\r\r\n"
    "6,last,row\r"
)


@pytest.mark.parametrize(
    "text",
    [
        RETURNS,
        RETURNS + "7,no,end",
        "a,b,c\r1,2,3\r4,5,6",
        "a,b,c\r\n" + "1,x,y\r2,v,w\n" * 300,
    ],
)
def test_rows_may_end_in_a_lone_return(spark, tmp_path, small_blocks, text):
    path = write(tmp_path / "returns.csv", text)
    assert spark_rows(spark, path, ["a", "b", "c"]) == python_rows(path)


def test_random_row_ends(spark, tmp_path, small_blocks):
    draw = random.Random(5)
    cells = ["x", "", "two words", '"q\r"', '"a\nb"', '"c\r\nd"', '"e""f"']
    for k in range(4):
        rows = (",".join(draw.choices(cells, k=2)) + draw.choice(["\r", "\n", "\r\n"]) for _ in range(120))
        path = write(tmp_path / f"{k}.csv", "a,b\r\n" + "".join(rows))
        assert spark_rows(spark, path, ["a", "b"]) == python_rows(path)
