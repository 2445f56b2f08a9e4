"""Chain files against a plain reader, wherever the text is cut between tasks."""

import random

import pytest

from helixspan.operators import liftover
from helixspan.sources import chains


def made_up(seed, n_chains):
    """Text of a chain file and its blocks, positions counted up one by one."""
    rng = random.Random(seed)
    text, blocks = ["##a comment", "#another"], []
    for number in range(n_chains):
        t_at, q_at = rng.randrange(10_000), rng.randrange(10_000)
        strand, score = rng.choice("+-"), rng.randrange(1000)
        chrom, n = str(rng.randrange(1, 4)), rng.randrange(1, 7)
        start, lines = (t_at, q_at), []
        for i in range(n):
            size, dt, dq = rng.randrange(1, 500), rng.randrange(50), rng.randrange(50)
            blocks.append((chrom, t_at, t_at + size, f"chr{chrom}", q_at, 50_000, strand, score))
            t_at, q_at = t_at + size, q_at + size
            if i < n - 1:
                lines.append(f"{size}\t{dt}\t{dq}")
                t_at, q_at = t_at + dt, q_at + dq
            else:
                lines.append(str(size))
        head = f"chain {score} chr{chrom} 60000 + {start[0]} {t_at} chr{chrom} 50000 {strand} {start[1]} {q_at} {number}"
        text += [head, *lines, ""]
    return text, blocks


def read(spark, path):
    return sorted(map(tuple, chains.read_chain(spark, str(path)).collect()))


@pytest.mark.parametrize("bytes_per_task", [37, 64, 101, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_wherever_the_text_is_cut(spark, tmp_path, bytes_per_task, end):
    text, blocks = made_up(bytes_per_task, 12)
    path = tmp_path / "a.chain"
    path.write_bytes(end.join(text).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_per_task))
    try:
        assert read(spark, path) == sorted(blocks)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_without_blank_lines_or_last_line_end(spark, tmp_path):
    text, blocks = made_up(5, 6)
    path = tmp_path / "a.chain"
    path.write_text("\n".join(line for line in text if line and not line.startswith("#")))
    assert read(spark, path) == sorted(blocks)


def test_equal_chains_stay_apart_and_an_empty_file_has_none(spark, tmp_path):
    one = "chain 7 chr1 900 + 10 30 chr1 900 + 0 25 1\n5 10 15\n5\n\n"
    (tmp_path / "twice.chain").write_text(one * 2)
    (tmp_path / "none.chain").write_text("")
    rows = [("1", 10, 15, "chr1", 0, 900, "+", 7), ("1", 25, 30, "chr1", 20, 900, "+", 7)]
    assert read(spark, tmp_path / "twice.chain") == sorted(rows * 2)
    assert read(spark, tmp_path / "none.chain") == []


@pytest.mark.parametrize("lines", ["5 10 15\n", "", "5 10 15\n4\n", "5 10 15\nx\n"])
def test_a_truncated_chain_fails(spark, tmp_path, lines):
    path = tmp_path / "cut.chain"
    path.write_text("chain 7 chr1 900 + 10 30 chr1 900 + 0 25 1\n" + lines)
    with pytest.raises(Exception, match="does not end"):
        read(spark, path)


def test_lifted_through_a_chain_file(spark, table, tmp_path):
    path = tmp_path / "a.chain"
    path.write_text("chain 7 chr2 900 + 10 30 chr2 100 - 0 25 1\n5 10 15\n5\n\n")
    segments = liftover.flatten_chain(chains.read_chain(spark, str(path)))
    sites = table([("2", p) for p in (10, 11, 15, 16, 26, 30, 31)], "chrom string, pos int")
    found = {r["pos"]: r["pos_b38"] for r in liftover.lift(sites, segments).collect()}
    # 0-based offsets 0 to 4 and 20 to 24 along the reverse strand of 100 bases.
    assert found == {10: None, 11: 100, 15: 96, 16: None, 26: 80, 30: 76, 31: None}
