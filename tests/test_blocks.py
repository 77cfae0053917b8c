"""Files split into many blocks: summaries, record counts, control checks and rejected lines."""

import random

import pytest

from loadworks.operators import checks as C
from loadworks.sources import files as FS


@pytest.fixture
def small_blocks(spark):
    """Files are split after a few hundred bytes."""
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts(seed=3):
    rng = random.Random(seed)
    out = {"empty": "", "blank": "\n \n\t\n", "one": "000|HDR", "two": "000|HDR\n000|0\n"}
    for n in range(12):
        lines = [f"001|{k}|{'x' * rng.randint(0, 90)}|{k}" for k in range(rng.randint(0, 40))]
        if n % 3 == 1 and lines:
            lines[rng.randrange(len(lines))] += "|extra"
        lines = ["000|HDR", *lines, f"000|{len(lines) + (n % 4 == 3)}"]
        for _ in range(rng.randint(0, 5)):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", "  "]))
        out[f"f{n}"] = "\n" * rng.choice([0, 0, 300]) + "\n".join(lines) + "\n" * rng.choice([0, 1, 250])
    return out


@pytest.fixture
def landed(tmp_path):
    for name, text in texts().items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def by_name(rows, *cols):
    return {r["file"].rpartition("/")[2]: tuple(r[c] for c in cols) for r in rows}


def expected(text):
    """(lines, filled, first_no, last_no, bad, first_fields, last_fields, last_value) of a file."""
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    filled = [(n, line) for n, line in enumerate(lines, 1) if line.strip()]
    if not filled:
        return len(lines), 0, None, None, 0, None, None, None
    fields = [len(line.split("|")) for _, line in filled]
    last = filled[-1][1].split("|")[-1]
    return (len(lines), len(filled), filled[0][0], filled[-1][0], sum(f != 4 for f in fields), fields[0], fields[-1],
            int(last) if last.isdigit() else None)


def test_summaries_of_split_files(spark, landed, small_blocks):
    blocks = FS.block_summaries(spark, landed, "|", 4)
    per_file = {}
    for r in blocks.collect():
        per_file.setdefault(r["file"], []).append(r["block"])
    assert max(map(len, per_file.values())) > 5  # the files really are in many blocks
    got = by_name(FS.fold_blocks(blocks).collect(), "lines", "filled", "first_no", "last_no", "bad", "first_fields",
                  "last_fields", "last_value")
    want = {n: expected(t) for n, t in texts().items() if t}
    assert {n: got[n] for n in want} == want


def test_record_counts_equal_those_of_numbered_lines(spark, landed, small_blocks):
    got = by_name(FS.count_records(spark, landed).collect(), "records")
    for name, text in texts().items():
        if not text:
            continue
        _, _, first, last, *_ = expected(text)
        assert got[name] == (max(0, last - first + 1 - 2) if first else 0,)
    assert got == by_name(FS.count_file_records(FS.number_lines(spark, landed)).collect(), "records")


def test_control_check_equals_the_check_of_lines(spark, landed, small_blocks):
    got = sorted(map(tuple, C.check_control_files(spark, landed, "|", 4).collect()))
    lines = FS.number_lines(spark, landed).filter("line rlike '\\\\S'")
    assert got == sorted(map(tuple, C.check_control_file(lines, "|", 4).collect()))
    assert {r[-1] for r in got} == {"PASS", "FAIL"}


def test_no_line_is_shuffled(spark, landed):
    for df in (FS.count_records(spark, landed), C.check_control_files(spark, landed, "|", 4)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 or plan.count("Relation") == 1  # one scan
        physical = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortAggregate" not in physical and "HashAggregate" in physical


def test_lines_of_another_width_are_set_aside_whole(spark, tmp_path):
    (tmp_path / "a").write_text('000|HDR\n001|1|"a|x\n001|2|b|y|z\n\n001||c\nlonely\n000|3\n')
    rows, rejects = FS.read_flat_checked(spark, str(tmp_path), ["org", "key", "name", "more"], "|")
    assert sorted((tuple(r)[1:] for r in rows.collect()), key=str) == sorted([
        ("000", "HDR", None, None), ("001", "1", '"a', "x"), ("001", None, "c", None), ("000", "3", None, None)], key=str)
    assert sorted(tuple(r)[1:] for r in rejects.collect()) == [
        ("001|2|b|y|z", 5, "too many fields"), ("lonely", 1, "too few fields")]
    plain = FS.read_flat(spark, str(tmp_path), ["org", "key", "name", "more"], "|")
    assert plain.count() == rows.count() + rejects.count()
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "x").write_text("")
    rows, rejects = FS.read_flat_checked(spark, str(empty), ["a"], "|", 1)
    assert rows.count() == rejects.count() == 0
