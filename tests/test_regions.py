"""Regions over lines, files and tasks against a line-by-line reader."""
import os
import random

import pytest

from threadcorpus.operators.corpus import insert_sentence_tags
from threadcorpus.sources import regions


def write_files(folder, lines, n_files):
    os.makedirs(folder, exist_ok=True)
    cut = sorted(random.Random(5).sample(range(1, len(lines)), n_files - 1)) if n_files > 1 else []
    for i, (lo, hi) in enumerate(zip([0, *cut], [*cut, len(lines)])):
        with open(os.path.join(folder, f"part-{i:05d}.txt"), "w", encoding="utf-8") as f:
            f.writelines(line + "\n" for line in lines[lo:hi])


def corpus(seed, n):
    rng, lines = random.Random(seed), ["<corpus>"]
    for i in range(n):
        lines.append(f'<text id="t{i}" title="a &amp; b{i}">')
        for j in range(rng.randrange(0, 4)):
            lines += [f'<comment id="c{i}_{j}">', "<p>"]
            for _ in range(rng.randrange(1, 30)):
                lines.append(rng.choice(["word", "", "texts", "é", "<texture>", "a < b"]))
            lines += ["</p>", "</comment>"]
        lines += ["</text>", ""]
    return [*lines, "</corpus>"]


def brute(lines, levels):
    out, number, inside = [], {l: -1 for l in levels}, {l: False for l in levels}
    for i, line in enumerate(lines):
        row = [i, line]
        for level in levels:
            if line == f"<{level}>" or line.startswith(f"<{level} "):
                number[level], inside[level] = number[level] + 1, True
            row.append(number[level] if inside[level] else None)
            if line == f"</{level}>":
                inside[level] = False
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("n_files, split_bytes, max_rows", [(1, None, 10**6), (7, None, 10**6), (3, 600, 10**6), (9, 600, 0)])
def test_regions_over_files_splits_and_tasks(spark, tmp_dir, n_files, split_bytes, max_rows):
    lines, levels = corpus(3, 40), ["text", "comment", "p"]
    write_files(os.path.join(tmp_dir, "v"), lines, n_files)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = regions.region_lines(spark, os.path.join(tmp_dir, "v"), levels, max_rows)
        assert sorted(map(tuple, found.collect())) == brute(lines, levels)
        tagged = regions.tag_sentences(spark, os.path.join(tmp_dir, "v"), max_rows).orderBy("line_no", "sub").select("line").collect()
        frame = spark.createDataFrame([("k", i, x) for i, x in enumerate(lines)], "key string, line_no int, line string")
        assert [r.line for r in tagged] == [r.line for r in insert_sentence_tags(frame, ["key"]).orderBy("line_no", "sub").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_one_region_over_all_files(spark, tmp_dir):
    lines = ['<text id="hot">', *("word" for _ in range(3000)), "</text>", '<text id="small">', "x", "</text>"]
    write_files(os.path.join(tmp_dir, "v"), lines, 8)
    found = regions.region_lines(spark, os.path.join(tmp_dir, "v"), ["text"])
    assert found.rdd.getNumPartitions() > 1
    table = [(r.region, r.attrs["id"], r.first_line, r.last_line) for r in regions.region_table(found, "text").orderBy("region").collect()]
    assert table == [(0, "hot", 0, 3001), (1, "small", 3002, 3004)]


def test_unclosed_stray_and_empty(spark, tmp_dir):
    lines = ["</text>", "a", "<text>", "b", "<text>", "c", "</text>", "</text>", "d"]
    for n in (1, 4):
        write_files(os.path.join(tmp_dir, f"v{n}"), lines, n)
        assert sorted(map(tuple, regions.region_lines(spark, os.path.join(tmp_dir, f"v{n}"), ["text"]).collect())) == brute(lines, ["text"])
    os.makedirs(os.path.join(tmp_dir, "none"))
    open(os.path.join(tmp_dir, "none", "part-0.txt"), "w").close()
    assert regions.region_lines(spark, os.path.join(tmp_dir, "none"), ["text"]).collect() == []
