"""The segmented scan gives the rows of the one-pass parser, whatever the split size."""
import os
import random

import pytest

from fundscope.operators import records, segments


def write(folder, files):
    for name, value in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(value.encode())


def expected(files):
    out = []
    for name, value in files.items():
        lo, hi = (int(x) for x in name.removesuffix(".txt").split("_")[2:])
        found = records.split_records(value, lo, hi)
        out += [(name, i, t, lo + len(found) >= hi) for i, t in found]
    return sorted(out)


def odd_file(rng, lo, hi, newline):
    parts = []
    for i in range(lo, hi):
        if rng.random() < 0.02:
            continue                                       # a record is missing
        text = "".join(rng.choice(["a ", "é", "\n", "\n\n", f"{i + 1}|", f"\n{i}|", f" {i + 2}| ", "7|", "|", "x" * 9])
                       for _ in range(rng.randrange(0, 9)))
        parts.append(f"{rng.choice(['', '0', ' '])}{i}|{text}" if rng.random() < 0.3 else f"{i}|{text}")
    return "\n".join(parts) + newline


@pytest.mark.parametrize("split", ["100", "1m"])
def test_equals_the_one_pass_parser(spark, tmp_path, split):
    rng = random.Random(11)
    files = {f"project_description_{lo}_{lo + 60}.txt": odd_file(rng, lo, lo + 60, end)
             for lo, end in ((0, ""), (60, "\n"), (500, "\n\n"), (900, ""))}
    files["project_description_3_5.txt"] = "before 3|3 |x\n3|y\n4|z\n9|q"
    files["project_description_5_6.txt"] = ""
    files["project_description_6_8.txt"] = "no marker\nat all"
    files["notes.txt"] = "0|not a description file"
    write(tmp_path, files)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = segments.read_lines(spark, str(tmp_path))              # stores them
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    n_segments = lines.select("file", "seg").distinct().count()
    got = sorted(map(tuple, segments.assemble_large(lines).collect()))
    files.pop("notes.txt")
    assert got == expected(files)
    assert n_segments > 30 if split == "100" else n_segments >= 5


def test_a_segment_function_is_few_rows():
    assert segments.stretches(list(range(100, 200))) == [(100, 199, 200)]
    for numbers in ([5, 3, 4, 6, 5], [1, 2, 2, 3, 1], [9, 8, 7]):
        found = segments.stretches(numbers)
        for entry in range(0, 12):
            want = entry
            for n in numbers:
                want += n == want
            assert next((x for a, b, x in found if a <= entry <= b), entry) == want
