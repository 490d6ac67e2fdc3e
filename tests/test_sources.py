"""Readers: field checks (S11), run ids, no-overlap failure."""
import pytest
from pyspark.errors.exceptions.captured import SparkRuntimeException

from judgeline.config import EvalConfig
from judgeline.operators.prefs import closure, evaluate_prefs, inconsistencies
from judgeline.plans.evaluate import evaluate
from judgeline.session import ensure_checkpoint_dir
from judgeline.sources import text_formats as T
from judgeline.sources.sinks import write_run


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_malformed_qrels_line_is_reported(spark, tmp_path):
    p = _write(tmp_path / "q.txt", "1 0 d1 1\n1 0 d2\n1 0 d3 0 extra\n")
    bad = T.malformed_lines(spark, p, 4).collect()
    assert sorted(r.n_fields for r in bad) == [3, 5]
    with pytest.raises(SparkRuntimeException, match="malformed qrels line.*1 0 d2"):
        T.read_qrels(spark, p).count()
    assert T.read_qrels(spark, p, strict=False).count() == 3 - 1


def test_run_reader_extra_fields_blank_lines_and_last_tag(spark, tmp_path):
    p = _write(tmp_path / "r.txt",
               "1 Q0 d1 1 2.5 first junk here\n\n1 Q0 d2 2 1.5 first\n2 Q0 d1 1 0.5 lasttag\n")
    rows = T.read_run(spark, p).collect()
    assert len(rows) == 3 and {r.run_id for r in rows} == {"lasttag"}
    rows = T.read_run(spark, p, run_id="line").collect()
    assert {r.run_id for r in rows} == {"first", "lasttag"}


def test_tabs_and_leading_whitespace(spark, tmp_path):
    p = _write(tmp_path / "q.txt", "\t 7\t0\tdocA\t2 \n")
    r = T.read_qrels(spark, p).first()
    assert (r.qid, r.docno, r.rel) == ("7", "docA", 2)


def test_no_overlap_fails(spark, tmp_path):
    runs = T.read_run(spark, _write(tmp_path / "r.txt", "1 Q0 d1 1 1.0 r\n"))
    qrels = T.read_qrels(spark, _write(tmp_path / "q.txt", "2 0 d1 1\n"))
    with pytest.raises(ValueError):
        evaluate(runs, qrels, "official").summary().collect()


def test_short_run_lines_stop_the_read(spark, tmp_path):
    p = _write(tmp_path / "r.txt", "1 Q0 d1 1 2.5 tag\n1 Q0 d2 2 1.5\n")
    with pytest.raises(SparkRuntimeException, match="malformed results line"):
        T.read_run(spark, p).collect()
    assert T.read_run(spark, p, strict=False).count() == 1


def test_faulty_input_raises_by_default(spark, tmp_path):
    runs = T.read_run(spark, _write(tmp_path / "r.txt", "1 Q0 d1 1 1.0 r\n1 Q0 d1 2 0.5 r\n"))
    qrels = T.read_qrels(spark, _write(tmp_path / "q.txt", "1 0 d1 1\n"))
    with pytest.raises(ValueError, match="duplicate"):
        evaluate(runs, qrels, "official")
    with pytest.raises(ValueError, match="duplicate"):
        evaluate(runs.limit(1), qrels.union(qrels), "official")
    assert evaluate(runs, qrels, "official", EvalConfig(strict=False)).summary().count() > 0
    prefs = T.read_prefs(spark, _write(tmp_path / "p.txt", "1 a s d1 1\n1 a s d1 2\n1 a s d2 0\n"))
    with pytest.raises(ValueError, match="inconsistent"):
        evaluate_prefs(runs, prefs, "all_prefs")
    with pytest.raises(KeyError, match="map"):
        evaluate_prefs(runs, prefs, ["map", "prefs_simp"])


def test_both_ways_and_cycles(spark, tmp_path):
    both = T.read_prefs(spark, _write(tmp_path / "p.txt", "1 a s d1 2\n1 a s d2 1\n1 a t d1 1\n1 a t d2 2\n"))
    kinds = {(r.docno, r.kind) for r in inconsistencies(both).collect()}
    assert kinds == {("d1", "preferred_both_ways"), ("d2", "preferred_both_ways")}
    ring = spark.createDataFrame([("1", "a", x, y) for x, y in ("ab", "bc", "cd", "da")], "qid string, jg string, hi string, lo string")
    with pytest.raises(ValueError, match="cycle"):
        closure(ring)
    chain = spark.createDataFrame([("1", "a", f"{i:02}", f"{i + 1:02}") for i in range(12)], "qid string, jg string, hi string, lo string")
    assert closure(chain).count() == 12 * 13 // 2


def test_read_docs(spark):
    t = spark.createDataFrame([(5, "x y", 1)], "id long, body string, n int")
    assert [tuple(r) for r in T.read_docs(t, "id", "body").collect()] == [("5", "x y")]


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


FIELDS = {"2x": (2, 2.0), "3e2": (3, 300.0), "2.5x": (2, 2.5), "abc": (0, 0.0), "1.9": (1, 1.9), "+7": (7, 7.0), "-4-": (-4, -4.0),
          "-": (0, 0.0), ".5": (0, 0.5), "5.": (5, 5.0), "2e": (2, 2.0), "1e+": (1, 1.0), "x1": (0, 0.0), "0x1f": (0, 0.0),
          "99999999999": (2147483647, 99999999999.0), "-" + "9" * 50: (-2147483648, -1e50), "--1": (0, 0.0), "1d": (1, 1.0),
          "-inf": (0, float("-inf")), "１": (0, 0.0), "1f": (1, 1.0), "00012": (12, 12.0)}


def test_number_fields(spark):
    df = spark.createDataFrame([(k,) for k in FIELDS], "c string")
    got = {r.c: (r.i, r.d) for r in df.select("c", T.leading_int(df.c).alias("i"), T.leading_double(df.c).alias("d")).collect()}
    assert got == FIELDS


def test_blank_judgement_lines_stop_the_read(spark, tmp_path):
    p = _write(tmp_path / "q.txt", "1 0 d1 1\n\n1 0 d2 1\n")
    for read in (T.read_qrels, T.read_qrels_jg, T.read_qrels_as_prefs):
        with pytest.raises(SparkRuntimeException, match="malformed"):
            read(spark, p).count()
        assert read(spark, p, strict=False).count() == 2
    with pytest.raises(SparkRuntimeException, match="malformed prefs line"):
        T.read_prefs(spark, _write(tmp_path / "p.txt", "1 a s d1 1\n \t\n")).count()
    assert [(r.line_no, r.line, r.n_fields) for r in T.malformed_lines(spark, p, 4).collect()] == [(2, "", 0)]
    assert T.malformed_lines(spark, p, 4, allow_blank=True).count() == 0


def test_line_numbers_over_blocks_and_files(spark, tmp_path):
    """A file read in many blocks, and several files packed into one task."""
    lines = {f"f{k}": [f"1 0 d{i} 1" if i % 37 else "short line" for i in range(n)] for k, n in enumerate((3000, 5, 1, 700))}
    for name, own in lines.items():
        _write(tmp_path / f"{name}.txt", "\n".join(own) + "\n")
    for size in ("2k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = T.malformed_lines(spark, str(tmp_path), 4).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        want = sorted((name, i + 1) for name, own in lines.items() for i, x in enumerate(own) if x == "short line")
        assert sorted((r.file.split("/")[-1][:-4], r.line_no) for r in got) == want


def test_run_files_are_in_rank_order(spark, tmp_path):
    import glob
    rows = [(f"r{k % 2}", f"{q}", f"d{k}", float(-k), k) for q in range(3) for k in range(1, 200)]
    runs = spark.createDataFrame(rows, "run_id string, qid string, docno string, score double, rank int").repartition(7)
    write_run(runs, str(tmp_path / "out"), parts=6)
    files = glob.glob(str(tmp_path / "out/run_id=*/part-*.txt"))
    assert 2 <= len(files) <= 6 + 2
    for run in ("r0", "r1"):
        text = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / f"out/run_id={run}/part-*.txt"))))
        got = [x.split() for x in text.splitlines()]
        want = sorted((r for r in rows if r[0] == run), key=lambda r: (r[1], r[4]))
        assert [(x[0], x[2], int(x[3])) for x in got] == [(r[1], r[2], r[4]) for r in want]
