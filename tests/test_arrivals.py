"""Manifests that arrive over several runs, with restarts and failures between them."""

import json

import pytest

from helixspan.sources import readers
from helixspan.streaming import arrivals

HEADER = "#chrom\tpos\tref\talt\tpval\tbeta\tsebeta\taf_alt\n"


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "manifests").mkdir()

    class Place:
        out = tmp_path / "out"

        def deliver(self, name, positions):
            rows = "".join(f"1\t{p}\tA\tC\t0.5\t0.1\t0.2\t0.4\n" for p in positions)
            (tmp_path / name).write_text(HEADER + rows)

        def announce(self, manifest, *studies):
            lines = [
                {"in_tsv": f"{tmp_path}/{name}", "study_id": study, "n_total": 1000, "n_cases": None, "other": 1}
                for study, name in studies
            ]
            text = "".join(json.dumps(line) + "\n" for line in lines)
            (tmp_path / "manifests" / manifest).write_text(text)

        def run(self, **options):
            return arrivals.ingest_arrived(
                spark, str(tmp_path / "manifests"), None, str(self.out), str(tmp_path / "state"),
                readers.FINNISH_GWAS, min_rows=1, **options,
            )

        def rows(self):
            return sorted((r.study_id, r.pos) for r in spark.read.parquet(str(self.out)).collect())

        def files(self):
            return {p: p.stat().st_mtime_ns for p in self.out.rglob("*.parquet")}

    return Place()


def test_every_manifest_is_taken_once(place):
    place.deliver("a.tsv", [1, 2])
    place.deliver("b.tsv", [3])
    place.announce("1.json", ("A", "a.tsv"))
    assert place.run() == 1
    first = place.files()
    assert place.rows() == [("A", 1), ("A", 2)]
    assert place.run() == 0  # a restart without news
    place.announce("2.json", ("B", "b.tsv"))
    assert place.run() == 1
    assert place.rows() == [("A", 1), ("A", 2), ("B", 3)]
    assert first.items() <= place.files().items()  # the finished study was left alone


def test_a_failed_batch_is_tried_again(place):
    place.deliver("a.tsv", [1])
    place.announce("1.json", ("A", "a.tsv"), ("B", "missing.tsv"))
    with pytest.raises(Exception, match="missing"):
        place.run()
    place.deliver("missing.tsv", [7])
    assert place.run() == 1
    assert place.rows() == [("A", 1), ("B", 7)]


def test_a_study_delivered_again_replaces_its_rows(place):
    place.deliver("old.tsv", [1, 2, 3])
    place.deliver("new.tsv", [4])
    place.announce("1.json", ("A", "old.tsv"))
    place.run()
    place.announce("2.json", ("A", "new.tsv"))
    place.run()
    assert place.rows() == [("A", 4)]


def test_small_batches_logs_and_empty_manifests(place, tmp_path):
    for i in range(2):
        place.deliver(f"{i}.tsv", [i + 1])
        place.announce(f"{i}.json", (f"S{i}", f"{i}.tsv"))
    place.announce("empty.json")
    assert place.run(files_per_batch=1, log=str(tmp_path / "log")) == 2
    assert place.rows() == [("S0", 1), ("S1", 2)]
    assert len(list((tmp_path / "log").glob("batch=*"))) == 2
