"""Tolerant reads, quarantine, discovery, required inputs."""

import pytest

from shelfwright.schemas import MAPPING, RAW
from shelfwright.sources import stage_files as files


def raw_line(row_id, name="n"):
    return ",".join([row_id, name] + [""] * (len(RAW) - 2))


def test_byte_order_mark_blank_rows_and_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("﻿" + ",".join(RAW) + "\n" + raw_line("1") + "\n" + ",".join([" "] * len(RAW)) + "\n" + raw_line("2"), "utf-8")
    rows = files.read_tolerant(spark, str(path), RAW).orderBy("ord").collect()
    assert [r.id for r in rows] == ["1", "2"]


def test_no_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(raw_line("1", '"a\nb"') + "\n" + raw_line("2"), "utf-8")
    rows = files.read_tolerant(spark, str(path), RAW).orderBy("ord").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "a\nb"), ("2", "n")]


def test_header_in_other_case_hides_its_columns(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(",".join(["ID", *RAW[1:]]) + "\n" + raw_line("1"), "utf-8")
    row = files.read_tolerant(spark, str(path), RAW).first()
    assert (row.id, row.name) == ("", "n")


def test_columns_are_read_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('public_id,extra,filename\np1,x,"f,""1"""\np2,y,\n', "utf-8")
    rows = files.read_stage(spark, str(path), MAPPING).orderBy("ord").collect()
    assert [(r.filename, r.secure_url, r.public_id) for r in rows] == [('f,"1"', "", "p1"), ("", "", "p2")]


def test_row_order_over_several_files(spark, tmp_path):
    for part in range(5):
        lines = "\n".join(f"f{part}_{n},u,p" for n in range(part + 1))
        (tmp_path / f"part-{part}.csv").write_text("filename,secure_url,public_id\n" + lines, "utf-8")
    rows = files.read_stage(spark, str(tmp_path), MAPPING).orderBy("ord").collect()
    assert [r.filename for r in rows] == [f"f{p}_{n}" for p in range(5) for n in range(p + 1)]
    assert [r.ord for r in rows] == list(range(15))


def test_lenient_scan(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b"filename,secure_url,public_id,more\nf\xff1,u1,p1,x,y\n\nf2,u2\n")
    rows = files.read_first_columns(spark, str(path)).orderBy("ord").collect()
    assert [(r.filename, r.secure_url, r.public_id) for r in rows] == [("f1", "u1", "p1"), ("f2", "u2", "")]


def test_missing_input(spark, tmp_path):
    assert files.read_stage(spark, str(tmp_path / "none"), RAW).count() == 0
    assert files.read_tolerant(spark, str(tmp_path / "none"), RAW).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_stage(spark, str(tmp_path / "none"), RAW, required=True)
    with pytest.raises(FileNotFoundError):
        files.read_mapping(spark, str(tmp_path / "a"), str(tmp_path / "b"), MAPPING)


def test_mapping_must_have_its_columns(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("filename,public_id\na,b\n", "utf-8")
    with pytest.raises(ValueError, match="secure_url"):
        files.read_mapping(spark, str(tmp_path / "none"), str(path), MAPPING)


def test_quarantine_copies_the_odd_table(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x,y\n1,2\n", "utf-8")
    assert files.read_or_quarantine(spark, str(path), RAW, str(tmp_path / "q"), "T").count() == 0
    assert files.read_stage(spark, str(tmp_path / "q" / "ts=T"), ["x", "y"]).first().y == "2"


def test_categories_from_file_names(spark, tmp_path):
    for name in ("vay", "ao_thun"):
        (tmp_path / f"{name}.csv").write_text("a\n", "utf-8")
    (tmp_path / "notes.txt").write_text("x", "utf-8")
    assert [r.category for r in files.discover_categories(spark, str(tmp_path)).collect()] == ["ao_thun", "vay"]


def test_merged_columns():
    assert files.merged_columns(["name", "a"], ["a", "b"], []) == ["id", "name", "a", "b"]
    assert files.merged_columns([], ["b"], ["id", "x"]) == ["id", "x", "b"]


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("filename,secure_url,public_id\nf1,u1,p1\n", "utf-8")
    (tmp_path / "b.csv").write_text("public_id,filename,secure_url\np2,f2,u2\n", "utf-8")
    (tmp_path / "c.csv").write_text("public_id\np3\n", "utf-8")
    rows = files.read_stage(spark, str(tmp_path), MAPPING).orderBy("ord").collect()
    assert [(r.filename, r.secure_url, r.public_id, r.ord) for r in rows] == [("f1", "u1", "p1", 0), ("f2", "u2", "p2", 1), ("", "", "p3", 2)]


def test_files_with_and_without_header_in_one_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeff" + ",".join(RAW) + "\n" + raw_line("1") + "\n", "utf-8")
    (tmp_path / "b.csv").write_text("\ufeff" + raw_line("2") + "\n" + raw_line("3") + "\n", "utf-8")
    (tmp_path / "c.csv").write_text(",".join(["ID", *RAW[1:]]) + "\n" + raw_line("4") + "\n", "utf-8")
    rows = files.read_tolerant(spark, str(tmp_path), RAW).orderBy("ord").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "n"), ("2", "n"), ("3", "n"), ("", "n")]


def test_only_odd_files_are_set_aside(spark, tmp_path):
    folder = tmp_path / "stage"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name\n1,x\n", "utf-8")
    (folder / "b.csv").write_text("name,id\ny,2\n", "utf-8")
    (folder / "c.csv").write_text("id\n3\n", "utf-8")
    kept = files.read_or_quarantine(spark, str(folder), ["id", "name"], str(tmp_path / "q"), "T").collect()
    assert [(r.id, r.name) for r in kept] == [("1", "x")]
    aside = [files.read_stage(spark, str(tmp_path / "q" / f"ts=T{n}"), ["id", "name"]).first() for n in ("", ".1")]
    assert sorted((r.id, r.name) for r in aside) == [("2", "y"), ("3", "")]


SHORT = ["filename", "secure_url", "public_id"]
WIDER = [
    "filename,secure_url,public_id\nf1,u1,p1\n",
    '"a,""\n",b,public_id,"c",secure_url,filename\n"x\ny",,p2,z,u2,f2\n',
    "filename,secure_url,public_id,d\nf3,u3,p3,w\n",
]


@pytest.fixture
def wider(tmp_path):
    (tmp_path / "in").mkdir()
    for n, text in enumerate(WIDER):
        (tmp_path / "in" / f"part{n}.csv").write_text(text, "utf-8")
    return str(tmp_path / "in")


def test_files_wider_than_the_first_one(spark, wider):
    rows = files.read_stage(spark, wider, SHORT).orderBy("ord").collect()
    assert [(r.filename, r.secure_url, r.public_id) for r in rows] == [(f"f{n}", f"u{n}", f"p{n}") for n in (1, 2, 3)]


def test_wider_files_are_put_aside(spark, wider, tmp_path):
    kept = files.read_or_quarantine(spark, wider, SHORT, str(tmp_path / "aside"), "T").collect()
    assert [r.filename for r in kept] == ["f1"]
    moved = files.read_stage(spark, str(tmp_path / "aside" / "*"), [*SHORT, "b", "c", "d"]).collect()
    assert sorted((r.filename, r.secure_url, r.public_id, r.c, r.d) for r in moved) == [("f2", "u2", "p2", "z", ""), ("f3", "u3", "p3", "", "w")]


@pytest.fixture
def many(tmp_path):
    """Twelve files of one size, each with its own order of columns."""
    (tmp_path / "many").mkdir()
    for part in range(12):
        names = SHORT if part % 2 else SHORT[::-1]
        lines = [",".join(f"{n[0]}{part:02}_{row:04}" for n in names) for row in range(300)]
        (tmp_path / "many" / f"part-{part:02}.csv").write_text("\n".join([",".join(names), *lines]), "utf-8")
    return str(tmp_path / "many")


READERS = {
    "stage": lambda spark, path, aside: files.read_stage(spark, path, SHORT),
    "tolerant": lambda spark, path, aside: files.read_tolerant(spark, path, SHORT),
    "quarantine": lambda spark, path, aside: files.read_or_quarantine(spark, path, SHORT, aside, "T"),
    "lenient": lambda spark, path, aside: files.read_first_columns(spark, path),
    "mapping": lambda spark, path, aside: files.read_mapping(spark, path, path, SHORT),
}


@pytest.mark.parametrize("reader", READERS)
def test_places_do_not_depend_on_the_number_of_cores(spark, many, tmp_path, reader, monkeypatch):
    scans, scan = [], files._import
    monkeypatch.setattr(files, "_import", lambda *a, **k: scans.append(a) or scan(*a, **k))
    outcomes = []
    for at_reading, later in (("4", "2"), ("2", "7"), ("12", "1")):
        try:
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", at_reading)
            rows = READERS[reader](spark, many, str(tmp_path / f"aside{later}"))
            # Executors join or leave between planning and reading.
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", later)
            outcomes.append([tuple(r) for r in rows.orderBy("ord").collect()])
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert outcomes[0] == outcomes[1] == outcomes[2] and len(scans) == 3
    places = [r[-1] for r in outcomes[0]]
    assert len(set(places)) == len(places) and not any(set(SHORT) & set(r[:-1]) for r in outcomes[0] if reader != "tolerant")
    if reader in ("stage", "mapping"):
        assert places == list(range(3600))
        assert [r[0] for r in outcomes[0]] == [f"f{part:02}_{row:04}" for part in range(12) for row in range(300)]


def test_files_are_parsed_once(spark, many):
    rows = files.read_stage(spark, many, SHORT)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "FileScan parquet" in plan


def test_replacement_characters_of_the_file_stay(spark, tmp_path):
    valid = "�é中\U0001f600".encode()
    broken = b"\x80" + valid[:3] + b"\xe2\x82" + b"z\xff" + valid[3:] + b"\xed\xa0\x80\xc0\xaf"
    for n, mark in ((1, b"\xef\xbb\xbf"), (2, b"")):
        (tmp_path / f"{n}.csv").write_bytes(mark + b"filename,secure_url,public_id,more\n" + broken + b',"a\n""b""",p,x\n')
    rows = files.read_first_columns(spark, str(tmp_path)).orderBy("ord").collect()
    assert rows[0].asDict() == rows[1].asDict() | {"ord": 0}
    assert (rows[0].filename, rows[0].secure_url) == (broken.decode("utf-8", "ignore"), 'a\n"b"') and "�" in rows[0].filename


def test_every_file_of_a_mapping_must_have_its_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("filename,secure_url,public_id\n1,2,3\n", "utf-8")
    (tmp_path / "b.csv").write_text("filename,public_id\n1,2\n", "utf-8")
    with pytest.raises(ValueError, match="secure_url"):
        files.read_mapping(spark, str(tmp_path), str(tmp_path), MAPPING)
