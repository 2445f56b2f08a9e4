"""Steps whose cost per task or per file must not grow with the table."""

import gzip

import pytest
from pyspark.sql import functions as F

from helixspan.functions import ids
from helixspan.operators import combine, windows
from helixspan.plans import exports
from helixspan.registry.files import _two_headers, header_groups
from helixspan.registry.views import Tables
from helixspan.sources import readers, sinks


def _delivered(folder, n):
    for i in range(n):
        (folder / f"p{i}.tsv").write_text(f"hm_chrom\thm_pos\n{i}\t{i}\n")


def _listing_tasks(spark, build):
    """The most tasks that a listing of paths was cut into while ``build`` ran."""
    tracker, group = spark.sparkContext.statusTracker(), "listing-test"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(i.numTasks for i in map(tracker.getStageInfo, stages) if i)


def test_many_files_are_listed_by_few_tasks(spark, tmp_path):
    _delivered(tmp_path, 300)
    paths = [str(p) for p in tmp_path.iterdir()]
    found = []

    def build():
        found.append(readers.read_mapped_by_header(spark, paths, readers.HARMONISED_GWAS))

    assert _listing_tasks(spark, build) <= 4 * spark.sparkContext.defaultParallelism < 300
    assert sorted(int(r.chrom) for r in found[0].collect()) == list(range(300))


def test_blank_first_line_is_no_header(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\nhm_chrom\thm_pos\n7\t70\n")
    rows = readers.read_mapped_by_header(spark, str(tmp_path), readers.HARMONISED_GWAS).collect()
    assert [(r.chrom, r.pos) for r in rows] == [("7", 70)]


def _lines(spark, folder, n, splits):
    rows = spark.range(0, n, 1, splits).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        (F.col("id") % 3 + 1).cast("int").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"),
        F.lit(0.1).alias("l_discount"), F.lit(0.1).alias("l_tax"), F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
    )
    rows.write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


def test_deliveries_are_written_by_all_tasks(spark, tmp_path):
    path = _two_headers(_lines(spark, tmp_path, 2000, 6))
    for folder in "ab":
        names = spark.read.text(f"{path}/{folder}").select(F.col("_metadata.file_name")).distinct()
        assert names.count() > 2


def test_headers_are_counted_by_delivery(spark, tmp_path):
    written, real = [], sinks.write_result_table

    def watched(df, path, **options):
        real(df, path, **options)
        written.append(spark.read.text(path).select(F.col("_metadata.file_name")).distinct().count())

    tables = _lines(spark, tmp_path, 2000, 6)
    sinks.write_result_table = watched
    try:
        rows = header_groups(tables).collect()
    finally:
        sinks.write_result_table = real
    assert {r.column_name: r.n_files for r in rows} == {"chrom1": 1, "chrom2": 1, "chrom3": 1, "pos": 3}
    assert min(written) > 1  # a chromosome is not in one task


def test_more_files_than_asked_for_where_rows_are_many(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 100, raising=False)
    df = table([("1", n) for n in range(1000)], "chrom string, pos int")
    sinks.write_by_position(df, str(tmp_path / "p"), 2)
    names = spark.read.parquet(str(tmp_path / "p")).groupBy(F.col("_metadata.file_name").alias("f")).count()
    counts = [r["count"] for r in names.collect()]
    assert sum(counts) == 1000 and len(counts) >= 8


def test_prefixes_name_the_column_once(table):
    df = table([("a.b_1",), ("axb_1",), ("xa.b_",), (None,)], "v string").select(F.upper("v").alias("code"))
    kept = combine.without_prefixes(df, "code", ["A.B_", "Q", "R"])
    assert sorted(str(r.code) for r in kept.collect()) == ["AXB_1", "None", "XA.B_"]
    condition = kept._jdf.queryExecution().optimizedPlan().toString().split("Filter", 1)[1].split("\n")[0]
    assert condition.count("upper") == 1
    assert combine.without_prefixes(df, "code", []).count() == 4


def test_frames_are_dealt_by_number_of_rows(table, monkeypatch):
    monkeypatch.setattr(windows, "ROWS_PER_TASK", 50, raising=False)
    rows = [("S", None, None, "1", n * 7 % 4001, 0.0 if n % 97 == 0 else 1.0) for n in range(1000)] * 2
    rows += [("S", None, None, "1", None, 0.0), ("S", None, None, None, 5, 0.0)]
    df = table(rows, "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, pval double")
    kept = windows.keep_near_by_frame(df, F.col("pval") <= 0.5, 10)
    hits = {r[4] for r in rows if r[5] == 0 and r[4] is not None and r[3]}
    wanted = sorted(r[4] for r in rows if r[4] is not None and r[3] and any(abs(r[4] - h) <= 10 for h in hits))
    assert sorted(r.pos for r in kept.collect()) == wanted
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert ", 41), REPARTITION_BY_NUM" in plan
    before_join = plan.split("Initial Plan", 1)[-1].split("LeftSemi", 1)[1]
    assert before_join.count("hashpartitioning(_cell") == 1  # dealt once for positions and frames
    assert not any("_tile" in line and "ENSURE_REQUIREMENTS" in line for line in before_join.split("\n"))


def test_whole_numbers_as_before(table):
    texts = ["12", " 12 ", "+7", "-7.9", "12345.0", "1e3", "X", "", ".5", "5.", "99999999999", "99999999999.0", None]
    df = table([(t,) for t in texts], "t string")
    old = F.regexp_replace("t", r"^\s*([+-]?[0-9]+)\.[0-9]*\s*$", "$1").try_cast("int")
    assert [(r.a, r.t) for r in df.select(ids.whole(F.col("t")).alias("a"), "t").collect()] == [
        (r.a, r.t) for r in df.select(old.alias("a"), "t").collect()
    ]


ODD = [
    ("p1", 1, " x ", 0.5), ("p1", 2, "", None), ("p1", 3, None, 1e-300), ("p2", 4, 'a"b\tc', -0.0),
    ("p2", 5, "NA", float("nan")), ("a/b=c %1+ü", 6, "#", 1e22), (None, 7, "é", 3.0), ("", 8, "\\", 4.0),
    ("p1", None, "line\nend", 5.0),
]


def _files(folder):
    """Lines after the header of every file, by folder, and all headers."""
    found, headers = {}, set()
    for file in folder.glob("*/part-*.gz"):
        header, _, rest = gzip.decompress(file.read_bytes()).decode().partition("\n")
        headers.add(header)
        found.setdefault(file.parent.name, []).extend(rest.split("\n"))
    return {name: sorted(lines) for name, lines in found.items()}, headers


def test_folders_hold_what_the_text_writer_of_spark_writes(spark, table, tmp_path):
    rows = table(ODD, "f string, `n 1` int, t string, `d\t\"` double")
    sinks.write_export(rows.repartition(5), str(tmp_path / "e"), "f")
    rows.repartition(1).write.partitionBy("f").csv(
        str(tmp_path / "s"), sep="\t", header=True, nullValue="NA", compression="gzip"
    )
    ours, theirs = _files(tmp_path / "e"), _files(tmp_path / "s")
    assert ours[1] == theirs[1] and ours[0].keys() == theirs[0].keys() and len(ours[0]) == 4
    strip = lambda found: {name: [x for x in lines if x] for name, lines in found.items()}
    assert strip(ours[0]) == strip(theirs[0])
    # A side file is one more file to make for every file; compressed text has its own checksum.
    assert not list((tmp_path / "e").glob("*/.*.crc"))
    assert {p.name for p in (tmp_path / "e").iterdir() if not p.is_dir()} == {"_SUCCESS"}


def test_rows_of_an_export_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 3000, 1, 6).selectExpr("concat('p', id % 70) AS f", "id AS x")
    sinks.write_export(rows.mapInArrow(counted, rows.schema), str(tmp_path / "e"), "f")
    assert made.value == 3000
    files = list((tmp_path / "e").glob("f=*/part-*"))
    assert len(files) == 70 and sum(len(x) for x in _files(tmp_path / "e")[0].values()) == 3000 + 70


def test_hot_folder_of_an_export_is_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "SHARED_BYTES", 20_000, raising=False)
    rows = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 50 = 0, concat('p', id % 7), 'hot') AS f", "id AS x")
    sinks.write_export(rows, str(tmp_path / "e"), "f")
    assert len(list((tmp_path / "e").glob("f=hot/part-*"))) > 4
    back = spark.read.option("basePath", str(tmp_path / "e")).csv(str(tmp_path / "e/f=*"), sep="\t", header=True)
    assert back.select("f", "x").distinct().count() == back.count() == 40_000


def test_failed_export_leaves_the_one_before(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4).selectExpr("concat('p', id % 3) AS f", "id AS x")
    sinks.write_export(rows, str(tmp_path / "e"), "f")
    before = _files(tmp_path / "e")
    with pytest.raises(Exception, match="no such row"):
        broken = rows.withColumn("x", F.expr("if(x = 70, raise_error('no such row'), x)"))
        sinks.write_export(broken, str(tmp_path / "e"), "f")
    assert _files(tmp_path / "e") == before
    assert sorted(p.name for p in (tmp_path / "e").iterdir()) == ["_SUCCESS", "f=p0", "f=p1", "f=p2"]
    sinks.write_export(rows.where("f = 'p1'"), str(tmp_path / "e"), "f")
    assert sorted(p.name for p in (tmp_path / "e").iterdir()) == ["_SUCCESS", "f=p1"]
    sinks.write_export(rows.where("false"), str(tmp_path / "e"), "f")
    assert [p.name for p in (tmp_path / "e").iterdir()] == ["_SUCCESS"]


def test_names_of_files_stay_out_of_python(spark, tmp_path, monkeypatch):
    _delivered(tmp_path, 40)
    (tmp_path / "odd[1]{*}.tsv").write_text("hm_pos\thm_chrom\n500\t5\n")
    (tmp_path / "a b%20+c.tsv").write_text("hm_pos\thm_chrom\n600\t6\n")
    calls, real = [], readers.literal_path
    monkeypatch.setattr(readers, "literal_path", lambda path: calls.append(path) or real(path))
    rows = readers.read_mapped_by_header(spark, str(tmp_path), readers.HARMONISED_GWAS, {"at": readers.source_file()})
    found = {(r.chrom, r.pos, r.at) for r in rows.collect()}
    assert len(calls) == 2
    assert found == {(str(i), i, f"{tmp_path}/p{i}.tsv") for i in range(40)} | {
        ("5", 500, f"{tmp_path}/odd[1]{{*}}.tsv"), ("6", 600, f"{tmp_path}/a b%20+c.tsv")
    }


def test_first_lines_at_any_line_end_and_with_a_mark(spark, tmp_path):
    texts = {"lf": "a\tb\n1\t2\n", "crlf": "a\tb\r\n1\t2\r\n", "cr": "a\tb\r1\t2\r", "none": "a\tb", "blank": "\n\na\n",
             "mark": "\ufeffa\tb\n1\t2\n", "empty": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = {r.file_path.rsplit("/", 1)[1]: r.header for r in readers.header_lines(spark, str(tmp_path)).collect()}
    assert found == {n: "" if n == "blank" else "a\tb" for n in texts if n != "empty"}


def test_paths_and_chromosomes_as_before(table):
    texts = ["file:/a/b", "file:///a/b", "file:a", "/a%20b+c%2Bd", "s3a://b/c+d", "x", "chrX", "chr", "Chr1", "", None]
    df = table([(t,) for t in texts], "t string")
    plain = F.url_decode(F.replace("t", F.lit("+"), F.lit("%2B")))
    rows = df.select(
        ids.clean_path(F.col("t")), F.regexp_replace(plain, "^file:/+", "/"),
        ids.strip_chr(F.col("t")), F.regexp_replace("t", "^chr", ""),
    ).collect()
    assert [(r[0], r[2]) for r in rows] == [(r[1], r[3]) for r in rows]


def test_phenotypes_are_joined_at_their_stored_size(table):
    rows = table(
        [("1:5:A:C", "p1", 10, 3.0, 0.1, 0.2, 0.5), ("chr1:6:A:C", "p1", 10, 3.0, 0.1, 0.2, 0.5)],
        "variant string, phenotype string, n_complete_samples int, AC double, beta double, se double, pval double",
    )
    variants = table([("1", 5, "A", "C", "rs5", 0.5), ("1", 6, "A", "C", "rs6", 0.6)],
        "chr string, pos int, ref string, alt string, rsid string, info double")
    phenotypes = table([("p1", "d", 9, 1, 5, 4)],
        "phenotype string, description string, n_non_missing int, n_missing int, n_controls int, n_cases int")
    out = exports.linear_model_export(rows, variants, phenotypes)
    assert out.columns[:6] == ["phenotype", "chromosome", "base_pair_location", "other_allele", "effect_allele", "variant"]
    assert sorted((r.variant_id, r.base_pair_location) for r in out.collect()) == [("rs5", 5), ("rs6", 6)]
    leaves = out._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = [leaves.apply(n).toString() for n in range(leaves.size()) if "_known" in leaves.apply(n).toString()]
    assert known and "parquet" in known[0]
