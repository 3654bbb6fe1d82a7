import gzip

import pytest

from wardflow.sources import landing, tables


@pytest.fixture
def drop(tmp_path):
    def write(name, text, packed=False):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        data = text.encode()
        path.write_bytes(gzip.compress(data, mtime=0) if packed else data)
        return path

    return write


def names(df):
    return {r.path.rsplit("/", 1)[-1]: r for r in df.collect()}


def test_reordered_and_new_columns_stay_under_their_names(spark, tmp_path, drop):
    drop("a.csv", "facility_id,work_date\nF1,2026-01-01\n")
    drop("b.csv", "work_date,facility_id,new_col\n2026-01-02,F2,x\n")
    drop("c.tsv", "work_date\tfacility_id\n2026-01-03\tF3\n")
    drop("d.csv.gz", '"facility_id","work_date"\r\nF4,2026-01-04\r\n', packed=True)
    rows = landing.read_landing(spark, str(tmp_path)).orderBy("facility_id").collect()
    assert [(r.facility_id, r.work_date, r.new_col, r.role_code) for r in rows] == [
        ("F1", "2026-01-01", None, None),
        ("F2", "2026-01-02", "x", None),
        ("F3", "2026-01-03", None, None),
        ("F4", "2026-01-04", None, None),
    ]


def test_paths_with_blanks_and_percent_signs(spark, tmp_path, drop):
    drop("ward 7/100% staff.csv", "facility_id,work_date\nF1,2026-01-01\n")
    drop("ward 8/a+b[1]{x}.csv", "facility_id,work_date\nF2,2026-01-01\n")
    assert landing.read_landing(spark, str(tmp_path)).count() == 2
    assert landing.file_manifest(spark, str(tmp_path)).count() == 2


def test_manifest_names_contents(spark, tmp_path, drop):
    text = "facility_id,work_date\nF1,2026-01-01\nF2,2026-01-02\n"
    drop("a.csv", text)
    drop("copy.csv", text)
    drop("other.csv", text.replace("F2", "F3"))
    drop("turned.csv", "facility_id,work_date\nF2,2026-01-02\nF1,2026-01-01\n")
    drop("moved.csv", "F1,2026-01-01\nfacility_id,work_date\nF2,2026-01-02\n")
    drop("z.csv.gz", text, packed=True)
    drop("none.csv", "")  # file scans leave out files without a byte
    found = names(landing.file_manifest(spark, str(tmp_path)))
    assert sorted(found) == ["a.csv", "copy.csv", "moved.csv", "other.csv", "turned.csv", "z.csv.gz"]
    assert {tuple(r.columns) for n, r in found.items() if n != "moved.csv"} == {("facility_id", "work_date")}
    assert found["a.csv"].file_checksum == found["copy.csv"].file_checksum
    assert len({r.file_checksum for r in found.values()}) == 5


def test_one_checksum_however_a_file_is_split(spark, tmp_path, drop):
    lines = [f"F{i},2026-01-{i % 28 + 1:02d}" for i in range(30000)]
    drop("big.csv", "\n".join(["facility_id,work_date", *lines]) + "\n")
    drop("swapped.csv", "\n".join(["facility_id,work_date", lines[-1], *lines[1:-1], lines[0]]) + "\n")
    found = []
    for size in ("128m", "50000", "7777"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found.append({n: r.file_checksum for n, r in names(landing.file_manifest(spark, str(tmp_path))).items()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2] and len(set(found[0].values())) == 2


def test_names_differ_by_case_and_blanks_only(spark, tmp_path, drop):
    drop("a.csv", "FACILITY_ID, Work_Date \nF1,2026-01-01\n")
    drop("b.csv", "facility_id,work_date\nF2,2026-01-02\n")
    drop("twice.csv", "facility_id,FACILITY_ID\nF3,F3\n")
    drop("unnamed.csv", "facility_id,\nF4,x\n")
    rows = landing.read_landing(spark, str(tmp_path)).orderBy("facility_id").collect()
    assert [(r.facility_id, r.work_date) for r in rows] == [("F1", "2026-01-01"), ("F2", "2026-01-02")]


def test_rows_longer_than_their_header_show(spark, tmp_path, drop):
    drop("a.csv", "facility_id,work_date\nF1,2026-01-01\nF2,2026-01-01,x\nF3,2026-01-01,,y\nF4\nF5,2026-01-01,\n\"F,6\",d\n")
    rows = landing.read_by_header(landing.file_lines(spark, str(tmp_path)), landing.file_headers(spark, str(tmp_path))).collect()
    assert {r.facility_id: r._surplus for r in rows} == {
        "F1": None, "F2": "x", "F3": "F3,2026-01-01,,y", "F4": None, "F5": None, "F,6": None,
    }


def test_known_content_is_skipped(spark, tmp_path, drop):
    drop("a.csv", "facility_id\nF1\n")
    drop("b.csv", "facility_id\nF1\n")
    drop("c.csv", "facility_id\nF2\n")
    manifest = landing.file_manifest(spark, str(tmp_path))
    none = manifest.limit(0)
    fresh = names(landing.new_files(manifest, none))
    assert sorted(fresh) == ["a.csv", "c.csv"]
    ledger = manifest.filter("path like '%b.csv'")
    assert sorted(names(landing.new_files(manifest, ledger))) == ["c.csv"]


def test_header_of_a_file_split_over_tasks(spark, tmp_path, drop):
    drop("big.csv", "facility_id,work_date\n" + "F1,2026-01-01\n" * 20000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = landing.file_headers(spark, str(tmp_path)).collect()
        manifest = landing.file_manifest(spark, str(tmp_path)).first()
        total = landing.read_landing(spark, str(tmp_path)).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.columns for r in rows] == [["facility_id", "work_date"]]
    assert manifest.columns == ["facility_id", "work_date"]
    assert total == 20000


def test_hints_fall_back_to_the_expected_columns(spark):
    assert landing.get_schema_hints(spark, "no_such_table", "no_such_db") == landing.DEFAULT_SCHEMA_HINTS
    assert landing.DEFAULT_SCHEMA_HINTS.startswith("facility_id STRING, work_date STRING")


def test_many_layouts_are_one_scan(spark, tmp_path, drop):
    for i in range(500):
        drop(f"f{i}.csv", f"extra_{i},work_date,facility_id\nx{i},2026-01-01,F{i}\n")
    headers = tables.stage(spark, landing.file_headers(spark, str(tmp_path)))
    rows = landing.read_by_header(landing.file_lines(spark, str(tmp_path)), headers)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Union" not in plan and len(rows.columns) == 8 + 500 + 2
    found = rows.select("facility_id", "work_date", "extra_17", "extra_499").collect()
    assert len(found) == 500 and {(r.facility_id, r.extra_17) for r in found if r.extra_17} == {("F17", "x17")}


def test_quoted_cells_are_cut_as_csv(spark, tmp_path, drop):
    text = 'facility_id,work_date,role_code\n"F,1,2,3,4",d,"a""b"\nF2,"","\\"x"\n\n   \n"F3",d,r,"y"\n"F4",d,r,,"z"\n5\'10" tall,d,r\n'
    path = drop("a.csv", text)
    given = spark.read.csv(str(path), header=True, enforceSchema=False).collect()
    rows = landing.read_by_header(landing.file_lines(spark, str(path)), landing.file_headers(spark, str(path))).collect()
    assert sorted(((r.facility_id, r.work_date, r.role_code) for r in rows), key=repr) == sorted((tuple(r)[:3] for r in given), key=repr)
    assert {r.facility_id: r._surplus for r in rows if r._surplus} == {"F3": "y", "F4": '"F4",d,r,,"z"'}


def test_no_file_and_no_line(spark, tmp_path, drop):
    drop("a.csv", "")
    drop("b.csv", "facility_id\n")
    assert landing.read_landing(spark, str(tmp_path)).count() == 0
    drop("c.csv.gz", "", packed=True)  # not empty, but without a line
    found = names(landing.file_manifest(spark, str(tmp_path)))
    assert found["c.csv.gz"].columns == [""] and found["c.csv.gz"]["first"] is None


def test_first_lines_are_found_without_sorting_lines(spark, tmp_path, drop):
    drop("a.csv", "facility_id,work_date\n" + "F1,2026-01-01\n" * 100)
    lines = landing.file_lines(spark, str(tmp_path))
    for frame in (landing.file_headers(spark, str(tmp_path)), landing.file_contents(lines), landing.file_manifest(spark, str(tmp_path))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Sort [value" not in plan
    found = landing.with_first_lines(lines, landing.file_contents(lines)).collect()
    assert [(r.line, r.line_count) for r in found] == [("facility_id,work_date", 101)]
