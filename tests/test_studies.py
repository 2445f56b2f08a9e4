import pytest

from helixspan import schema
from helixspan.operators import combine, studies
from helixspan.plans import studies as plans


@pytest.mark.parametrize(
    "info, sizes, labels",
    [
        ("1,234 European ancestry cases, 5,678 European ancestry controls", (1234, 5678, None), "European"),
        ("100 South Asian ancestry individuals", (None, None, 100), "South Asian"),
        ("100 Asian cases and controls, about 20 Latin American men", (100, None, 20), "Asian,Latino"),
        ("up to 3 Finnish, 4 British individuals", (None, None, 7), "Finnish,British"),
        ("NR", (None, None, None), ""),
        (None, (None, None, None), ""),
        (", cases", (None, None, None), ""),
    ],
)
def test_sample_descriptions(table, info, sizes, labels):
    df = studies.add_ancestries(studies.add_sample_sizes(table([(info,)], "sample_info string")))
    row = df.first()
    assert (row.n_cases, row.n_controls, row.n_quant) == sizes
    assert row.ancestries == labels


def test_skip_completed_twice_adds_nothing(table):
    work = table([("a",), ("b",), ("c",)], "study_id string")
    done = studies.completed_studies(table([("/o/a.parquet/_SUCCESS",)], "path string"))
    todo = combine.not_done(work, done)
    assert sorted(r[0] for r in todo.collect()) == ["b", "c"]
    assert combine.not_done(todo, work).count() == 0


def test_incremental_union_only_adds_new_studies(table):
    finished = table([("a", 1)], "study_id string, x int")
    new = table([("a", 2), ("b", 3)], "study_id string, x int")
    once = combine.extend(finished, new)
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3)]
    assert combine.extend(once, new).count() == 2


def test_repeated_ids_go_entirely(table):
    rows = [("hot", n) for n in range(500)] + [("a", 1), ("b", 2)]
    df = table(rows, "study_id string, x int")
    assert sorted(map(tuple, combine.drop_repeated_ids(df).collect())) == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in combine.id_counts(df).collect()] == [("hot", 500)]


def test_metadata_keeps_vanished_studies_and_sorts(table):
    paths = table([("/s/GCST1/f",), ("/s/GCST2/f",), ("/s/other/f",), ("/s/GCST3/f",)], "gwascat_path string")
    info = table([("GCST1", "1", "t", "5 Finnish"), ("GCST2", "1", "t", "6 cases")],
                 "study_id string, pmid string, trait string, sample_info string")
    previous = table([("GCST1", "seen"), ("GCST9", "gone")], "study_id string, note string")
    done = table([("/o/GCST1.parquet/_SUCCESS",)], "path string")
    rows = plans.metadata_table(paths, info, previous, done).collect()
    assert [(r.study_id, r.ingested, r.note) for r in rows] == [
        ("GCST2", None, None), ("GCST9", None, "gone"), ("GCST1", "1", "seen"),
    ]
    assert rows[0].n_cases == 6 and rows[2].ancestries == "Finnish"


def test_conform_orders_types_and_fills(table):
    df = table([("5", 1.0, "x")], "pos string, mac double, junk string")
    row = schema.conform(df, schema.QTL_SCHEMA)
    assert [f.name for f in row.schema] == [f.name for f in schema.QTL_SCHEMA]
    assert row.first().pos == 5 and row.first().mac == 1 and row.first().gene_id is None


def test_unknown_chromosomes(table):
    df = table([("1",), ("X",), ("MT",), ("chr1",), ("23",), (None,)], "chrom string")
    assert sorted(str(r[0]) for r in schema.unknown_chromosomes(df).collect()) == ["23", "None", "chr1"]


def test_work_status(table):
    rows = [("1", ""), (None, "1"), (None, "1"), (None, None)]
    df = table(rows, "ingested string, to_ingest string")
    df = df.withColumn("to_ingest", df.to_ingest.try_cast("int"))
    assert tuple(studies.work_status(df, df.limit(1)).first()) == (1, 2, 1, 1, 1)


def test_selections(table):
    df = table([("a", "ge"), ("b", "exon"), ("c", "microarray")], "study string, quant_method string")
    assert sorted(r.study for r in studies.wanted_quantifications(df).collect()) == ["a", "c"]
    assert [r.study for r in studies.select_studies(df, "quant_method", "^ex").collect()] == ["b"]
    paths = table([("/x/a.tsv",)], "path string")
    work = table([("/x/a.tsv", 1), ("/x/b.tsv", 2)], "in_tsv string, n int")
    assert [r.n for r in combine.existing_only(work, paths, "in_tsv").collect()] == [1]
    coded = table([("NEALE2_670_1",), ("NEALE2_6700_1",), (None,)], "code string")
    kept = combine.without_prefixes(coded, "code", studies.BIOBANK_EXCLUDED).collect()
    assert sorted(str(r.code) for r in kept) == ["NEALE2_6700_1", "None"]
