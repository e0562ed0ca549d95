"""Readers and writers: FASTA edge cases, NA round trips, ragged TSV, per-primer output."""

import os

import pytest

from barcodeforge.sources import io


def test_columns_are_found_by_name(spark, scratch):
    p = os.path.join(scratch, "primers.tsv")
    with open(p, "w") as f:
        f.write("gene\tlength\tnote\treverse_sequence\tprimer\tforward_sequence\nCOX1\t658\tx\tTTT\tLCO\tAAA\n")
    r = io.read_primers(spark, p).first()
    assert (r["primer"], r["gene"], r["forward_sequence"], r["reverse_sequence"], r["length"]) == ("LCO", "COX1", "AAA", "TTT", 658)
    assert io.read_primers(spark, p).columns == ["primer", "gene", "forward_sequence", "reverse_sequence", "length"]
    short = os.path.join(scratch, "short.tsv")
    with open(short, "w") as f:
        f.write("primer\tgene\nLCO\tCOX1\n")
    with pytest.raises(ValueError, match="forward_sequence"):
        io.read_primers(spark, short)


def test_many_files_carry_their_name_and_must_agree(spark, scratch):
    for name, head in (("seeds_P1.csv", "accession,length\na,1\n"), ("seeds_P2.csv", "accession,length\nb,2\n")):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(head)
    rows = io.read_partitioned(spark, scratch, glob="seeds_*.csv", name_col="primer_name",
                               name_pattern=r"seeds_([^/]+)\.csv$").collect()
    assert {(r["accession"], r["length"], r["primer_name"]) for r in rows} == {("a", "1", "P1"), ("b", "2", "P2")}
    with open(os.path.join(scratch, "seeds_P3.csv"), "w") as f:
        f.write("length,accession\n3,c\n")
    with pytest.raises(Exception):
        io.read_partitioned(spark, scratch, glob="seeds_*.csv").collect()


def test_fasta_edge_cases(spark, scratch):
    p = os.path.join(scratch, "a.fa")
    with open(p, "w", newline="") as f:
        f.write(">acc1 desc with > inside\r\nACGT\r\nACGT\r\n>acc2;fam;sp\nAC\nGT\nNN\n>empty\n>acc3\nTTTT")
    rows = {r["header"]: r["sequence"] for r in io.read_fasta(spark, p).collect()}
    assert rows == {"acc1 desc with > inside": "ACGTACGT", "acc2;fam;sp": "ACGTNN", "empty": "", "acc3": "TTTT"}


def test_fasta_split_across_tasks(spark, scratch):
    p = os.path.join(scratch, "big.fa")
    with open(p, "w") as f:
        for i in range(500):
            f.write(f">r{i} x\n" + "ACGT" * 30 + "\n" + "GG" * 10 + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = io.read_fasta(spark, p)
        assert df.rdd.getNumPartitions() > 1
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 500
    assert all(r["sequence"] == "ACGT" * 30 + "GG" * 10 for r in rows)
    assert {r["header"] for r in rows} == {f"r{i} x" for i in range(500)}


def test_fasta_roundtrip_and_wrap(spark, scratch):
    df = spark.createDataFrame([("a;b;NA", "ACGT" * 40), ("c", "A")], "header string, sequence string")
    out = os.path.join(scratch, "out")
    io.write_fasta(df, out, width=60)
    back = {r["header"]: r["sequence"] for r in io.read_fasta(spark, out).collect()}
    assert back == {"a;b;NA": "ACGT" * 40, "c": "A"}


def test_csv_na_roundtrip(spark, scratch):
    df = spark.createDataFrame([("x", None, 1), ("y", "", 2)], "a string, b string, n int")
    out = os.path.join(scratch, "t.csv")
    io.write_csv(df, out)
    back = io.read_table_csv(spark, out, df.schema).orderBy("a").collect()
    assert back[0]["b"] is None and back[1]["b"] == "" and back[1]["n"] == 2


def test_bold_tsv_ragged_and_quotes(spark, scratch):
    p = os.path.join(scratch, "bold.tsv")
    with open(p, "w") as f:
        f.write("processid\tspecies\tsubspecies\tnuc\n")
        f.write('P-1\tApis "x" mellifera\tNA\tACGT\n')
        f.write("P-2\tBombus\n")
    rows = {r["processid"]: r for r in io.read_bold(spark, p).collect()}
    assert rows["P-1"]["species"] == 'Apis "x" mellifera' and rows["P-1"]["subspecies"] is None
    assert rows["P-2"]["nuc"] is None


def test_per_primer_partitions_and_lines(spark, scratch):
    df = spark.createDataFrame([("P1", "a1", "ACGT"), ("P1", "a2", "GGGG"), ("P3", "a3", "TTTT")],
                               "primer_name string, accession string, sequence string")
    out = os.path.join(scratch, "pp")
    io.write_per_primer(df, out, fmt="fasta")
    assert sorted(d for d in os.listdir(out) if d.startswith("primer_name=")) == ["primer_name=P1", "primer_name=P3"]
    back = io.read_fasta(spark, os.path.join(out, "primer_name=P1")).collect()
    assert sorted(r["header"] for r in back) == ["a1", "a2"]
    lines = os.path.join(scratch, "lines")
    io.write_lines(df, "accession", lines)
    assert sorted(r["value"] for r in spark.read.text(lines).collect()) == ["a1", "a2", "a3"]


def test_streaming_fasta_ingest(spark, scratch):
    from barcodeforge.streaming.ingest import ingest_fasta

    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    with open(os.path.join(src, "x.fa"), "w") as f:
        f.write(">a1 one\n--acgt\nNNAC\n>a2 two\nGGGG\n")
    q = ingest_fasta(spark, src, os.path.join(scratch, "table"), os.path.join(scratch, "ckpt"), normalise=True)
    q.awaitTermination(120)
    rows = {r["accession"]: r["sequence"] for r in spark.read.parquet(os.path.join(scratch, "table")).collect()}
    assert rows == {"a1": "ACGTNNAC", "a2": "GGGG"}


def test_partitioned_read_taxonomy_and_authority(spark, scratch):
    from barcodeforge.functions.columns import columns_between

    a = spark.createDataFrame([("x", 1)], "k string, v int")
    io.write_tsv(a, os.path.join(scratch, "in", "01_p1.tsv"))
    io.write_tsv(a, os.path.join(scratch, "in", "01_p2.tsv"))
    io.write_tsv(a, os.path.join(scratch, "in", "02_other.tsv"))
    df = io.read_partitioned(spark, os.path.join(scratch, "in", "01_*"), id_col="file", sep="\t",
                             schema=a.schema)
    files = sorted({r["file"].split("/")[-2] for r in df.collect()})
    assert files == ["01_p1.tsv", "01_p2.tsv"]
    root = os.path.join(scratch, "tax")
    for name, data, schema in (("names", [(1, "Apis", "scientific name")], "taxid long, name string, name_class string"),
                               ("nodes", [(1, None, "genus")], "taxid long, parent_taxid long, rank string"),
                               ("accession_taxa", [("AB1.1", 1)], "accession string, taxid long")):
        io.write_table(spark.createDataFrame(data, schema), os.path.join(root, name))
    names, nodes, acc = io.read_taxonomy(spark, root)
    assert names.count() == nodes.count() == acc.count() == 1
    auth = spark.createDataFrame([("Apis", 3, "Exact", "1", "A", "A", "Accepted"), ("Apis", 4, "Exact", "2", "A", "A", "Accepted")],
                                 io.AUTHORITY_SCHEMA)
    io.write_table(auth, os.path.join(scratch, "auth"))
    assert io.read_name_authority(spark, os.path.join(scratch, "auth"), data_source=3).count() == 1
    assert columns_between(auth, "match_type", "current_name") == ["match_type", "current_record_id", "current_name"]


def test_blank_cells_are_not_missing(spark, scratch):
    p = os.path.join(scratch, "bold.tsv")
    with open(p, "w") as f:
        f.write('processid\tspecies\tsubspecies\tnuc\nP-1\t\tNA\tACGT\nP-2\tApis\t\t\nP-3\t\nP-4\t"\t"\tA\nP-5\ta\tb\tc\td\n')
    rows = {r[0]: tuple(r)[1:] for r in io.read_bold(spark, p).collect()}
    assert rows == {"P-1": ("", None, "ACGT"), "P-2": ("Apis", "", ""), "P-3": ("", None, None), "P-4": ('"', '"', "A"), "P-5": ("a", "b", "c")}
    assert {r[0] for r in io.read_bold(spark, p).where("subspecies is null").select("processid").collect()} == {"P-1", "P-3"}
    p = os.path.join(scratch, "t.csv")
    with open(p, "w") as f:
        f.write('a,b,n\nx,,1\ny,"",\n"u,v","w ""q"" ,"\nz,NA,NA\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("a", T.StringType())])
    rows = {r["a"]: (r["b"], r["n"]) for r in io.read_table_csv(spark, p, schema).collect()}
    assert rows == {"x": ("", 1), "y": ("", None), "u,v": ('w "q" ,', None), "z": (None, None)}


def test_fasta_keeps_records_without_name_or_sequence(spark, scratch):
    df = spark.createDataFrame([("h", "ACGT"), (None, "GG"), ("e", None)], "header string, sequence string")
    out = os.path.join(scratch, "out")
    io.write_fasta(df, out, width=3)
    assert {(r[0], r[1]) for r in io.read_fasta(spark, out).collect()} == {("h", "ACGT"), ("NA", "GG"), ("e", "")}


@pytest.mark.parametrize("fmt", ["csv", "fasta", "parquet"])
def test_primer_names_survive_paths(spark, scratch, fmt):
    names = ["mlCOI:F/jg R", "a+b%2F", "007", "ä=ü#?", None, "x y"]
    df = spark.createDataFrame([(n, f"a{k}", "ACGT") for k, n in enumerate(names)], "primer_name string, accession string, sequence string")
    out = os.path.join(scratch, "pp")
    io.write_per_primer(df, out, fmt=fmt)
    back = io.read_per_primer(spark, out, fmt=fmt)
    assert {(r["primer_name"], r["accession"], r["sequence"]) for r in back.collect()} == {(n, f"a{k}", "ACGT") for k, n in enumerate(names)}


def test_file_names_are_decoded(spark, scratch):
    for name in ("seeds_a b+c%41.csv", "seeds_ä.csv"):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("k\n1\n")
    rows = io.read_partitioned(spark, scratch, glob="seeds_*.csv", name_col="primer", name_pattern=r"seeds_([^/]+)\.csv$").collect()
    assert {r["primer"] for r in rows} == {"a b+c%41", "ä"}
    assert all(os.path.exists(r["path"].split("file:")[-1].replace("//", "")) for r in rows)


def test_files_of_a_primer_follow_its_rows(spark, scratch):
    df = spark.range(2000).selectExpr("CASE WHEN id % 10 = 0 THEN 'rare' WHEN id % 10 < 9 THEN 'hot' END AS primer_name", "id AS accession").repartition(40)
    out = os.path.join(scratch, "pp")
    io.write_per_primer(df, out, file_rows=300)
    files = {d: len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".csv")]) for d in os.listdir(out) if "=" in d}
    assert files["primer_name=rare"] == files["primer_name=__HIVE_DEFAULT_PARTITION__"] == 1
    assert 2 <= files["primer_name=hot"] <= 6
    back = io.read_per_primer(spark, out)
    assert back.count() == back.distinct().count() == 2000
