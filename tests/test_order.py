"""Record order must not depend on splits, cores or how files are packed into tasks."""

import pytest

from certweave.operators import audit
from certweave.sources import readers
from certweave.sources.order import first_rows, nth_smallest

LAYOUTS = [("128m", "4m"), ("37", "1"), ("200", "1"), ("1k", "8k")]


@pytest.fixture
def each_layout(spark):
    """Runs a read under several split sizes."""
    def run(read):
        before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        out = []
        try:
            for most, opening in LAYOUTS:
                spark.conf.set("spark.sql.files.maxPartitionBytes", most)
                spark.conf.set("spark.sql.files.openCostInBytes", opening)
                out.append(read())
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        return out

    return run


def test_lines_keep_their_places(spark, tmp_path, each_layout):
    texts = {"b.jsonl": "".join(f'{{"Id":"b{n}"}}\n' for n in range(60)), "a.jsonl": "".join(f'{{"Id":"é{n}"}}\r\n' for n in range(45)) + "\n\n" + '{"Id":"end"}', "c.jsonl": "", "d.jsonl": "x\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    want, at = [], 0
    for name in sorted(texts):
        for line in texts[name].replace("\r\n", "\n").encode().splitlines():
            want.append((at, line.decode(), name))
            at += len(line) + 1
    for got in each_layout(lambda: sorted((r._record_seq, r.value, r._source_file) for r in readers.read_lines(spark, str(tmp_path)).collect())):
        assert got == want


def test_elements_keep_their_places(spark, tmp_path, each_layout):
    for folder, encoding in (("2", "windows-1251"), ("1", "utf-8"), ("10", "koi8-r")):
        (tmp_path / folder).mkdir()
        body = "".join(f"<Certificate><Id>{folder}-{n}</Id>" + ("" if n % 7 == 3 else "<StatusName>Действует</StatusName></Certificate>") + ("<Certificate/>" if n % 5 == 0 else "") for n in range(40))
        (tmp_path / folder / "data.xml").write_bytes(f'<?xml version="1.0" encoding="{encoding}"?><OpenData>{body}</OpenData>'.encode(encoding))

    def read():
        rows = readers.read_xml(spark, str(tmp_path / "*")).orderBy("_record_seq").collect()
        return [(r._record_seq, r.Id, r.StatusName, r._corrupt_record) for r in rows]

    first, *others = each_layout(read)
    assert len({r[0] for r in first}) == len(first) and all(got == first for got in others)
    # in path order, inside a file in its order; an element without a closing tag keeps its text only
    ids = [r[1] for r in first if r[1]]
    assert ids == [f"{f}-{n}" for f in ("1", "10", "2") for n in range(40) if n % 7 != 3]
    assert {r[2] for r in first if r[1]} == {"Действует"}


def test_first_lines_are_the_files_first(spark, tmp_path, each_layout):
    (tmp_path / "a.jsonl").write_text("".join(f"{n}\n\n" for n in range(200)))
    for got in each_layout(lambda: [r.value for r in readers.limit_lines(readers.read_lines(spark, str(tmp_path / "a.jsonl")), 30).collect()]):
        assert got == [str(n) for n in range(30)]


def test_many_first_rows_by_counting(spark):
    rows = spark.range(5000).selectExpr("(id * 7919) % 5003 * 1000000007 as at")
    want = sorted(r.at for r in rows.collect())
    for n in (1, 2, 4999, 5000):
        assert nth_smallest(rows, n) == want[n - 1]
        assert sorted(r.at for r in first_rows(rows, n, "at", most=0).collect()) == want[:n]
    assert nth_smallest(rows, 5001) is None and first_rows(rows, 6000, "at", most=0).count() == 5000
    assert nth_smallest(rows.limit(0), 1) is None and nth_smallest(spark.createDataFrame([(-(1 << 63),), ((1 << 63) - 1,), (5,), (5,)], "v long"), 3) == 5


def test_unknown_tags_of_elements(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<O><Certificate><Id>1</Id><n:New><Id/><Sub x='1'/></n:New><Open><Id>2</Id></Certificate><Certificate><Sub/><New/></Certificate></O>")
    got = audit.unknown_xml_tags(readers.read_elements(spark, str(tmp_path / "a.xml")))
    assert sorted(map(tuple, got.collect())) == [("New", "Certificate/New"), ("Open", "Certificate/Open"), ("Sub", "Certificate/New/Sub")]


def test_utf16_files_beside_others_in_one_scan(spark, tmp_path):
    kinds = {"1": "windows-1251", "2": "utf-16-le", "3": "utf-8", "4": "utf-16-be", "5": "utf-16-le", "6": "koi8-r"}
    want = []
    for name, encoding in kinds.items():
        ids = [f"Ж{name}-{i}" for i in range(40)]
        body = "".join(f"<Certificate><Id>{x}</Id><StatusName>Действующее № ы{'Ы' * 60}</StatusName></Certificate>\n" for x in ids)
        mark = "\ufeff" if name in "24" else ""
        declared = "utf-16" if encoding.startswith("utf-16") else encoding
        text = f'{mark}<?xml version="1.0" encoding="{declared}"?><OpenData>{body}</OpenData>'.replace("№", "N" if name == "6" else "№")
        (tmp_path / f"{name}.xml").write_bytes(text.encode(encoding) + (b"\n" if name == "5" else b""))  # half a sign at the end
        want += ids
    answers = []
    for most in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            answers.append([(r.Id, r._record_seq, r.StatusName) for r in readers.read_xml(spark, str(tmp_path), wide=True).orderBy("_record_seq").collect()])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [a[0] for a in answers[0]] == want and answers[0] == answers[1]
    assert {a[2].replace("№", "N") for a in answers[0]} == {"Действующее N ы" + "Ы" * 60}
    with pytest.raises(Exception, match="UTF-16"):
        readers.read_xml(spark, str(tmp_path)).collect()
    given = readers.read_xml(spark, str(tmp_path / "5.xml"), encoding="UTF-16LE")
    assert [r.Id for r in given.orderBy("_record_seq").collect()] == want[160:200]
