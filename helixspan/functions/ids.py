"""Column functions that take identifiers, paths and file names apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole(text: Column) -> Column:
    """Integer in a text; decimals, as in ``12345.0``, are cut off, other texts become null.

    Only texts that are no plain integer meet the pattern.
    """
    cut = F.regexp_replace(text, r"^\s*([+-]?[0-9]+)\.[0-9]*\s*$", "$1")
    return F.coalesce(text.try_cast("int"), cut.try_cast("int"))


def strip_chr(chrom: Column) -> Column:
    return F.when(chrom.startswith("chr"), F.substr(chrom, F.lit(4))).otherwise(chrom)


def variant_parts(variant: Column, separator: str) -> dict[str, Column]:
    """chrom, pos, ref and alt of ids such as ``1_55_A_G``, ``chr1_55_A_G_b38`` or ``1:55:A:G``."""
    pieces = F.split(variant, separator)
    return {
        "chrom": strip_chr(F.get(pieces, F.lit(0))),
        "pos": whole(F.get(pieces, F.lit(1))),
        "ref": F.get(pieces, F.lit(2)),
        "alt": F.get(pieces, F.lit(3)),
    }


def before_first_dot(text: Column) -> Column:
    return F.substring_index(text, ".", 1)


def drop_last_suffix(text: Column) -> Column:
    """Remove the last ``.N`` and keep earlier dots."""
    return F.regexp_replace(text, r"\.[^.]*$", "")


def folder_safe(text: Column) -> Column:
    return F.replace(text, F.lit(":"), F.lit("^"))


def dots_to_underscores(text: Column) -> Column:
    return F.replace(text, F.lit("."), F.lit("_"))


def junction_parts(junction: Column) -> dict[str, Column]:
    """Phenotype id, cluster and gene of ``chr1:15038:15796:clu_7:ENSG00000000001.5``."""
    pieces = F.split(junction, ":")
    return {
        "phenotype_id": folder_safe(drop_last_suffix(junction)),
        "splicing_cluster": F.get(pieces, F.lit(3)),
        "gene_id": before_first_dot(F.get(pieces, F.lit(4))),
    }


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """File name up to its first dot."""
    return before_first_dot(base_name(path))


def file_prefix(path: Column, marker: str) -> Column:
    """File name up to ``marker``."""
    return F.substring_index(base_name(path), marker, 1)


def clean_path(path: Column) -> Column:
    """A path as Spark reports it, without encoding and without the scheme of local files.

    Every row of a file asks for it, so paths without encoded characters meet no pattern.
    """
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    plain = F.when(path.contains("%"), decoded).otherwise(path)
    bare = F.concat(F.lit("/"), F.ltrim(F.substr(plain, F.lit(6)), F.lit("/")))
    return F.when(plain.startswith("file:/"), bare).otherwise(plain)


def parent_folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def accession(text: Column) -> Column:
    """First study accession in free text, '' when there is none."""
    return F.regexp_extract(text, "(GCST[0-9]+)", 1)


def path_segment(path: Column, index: int) -> Column:
    return F.get(F.split(path, "/"), F.lit(index))


def study_of_output(path: Column) -> Column:
    """Study id of ``.../<study>.parquet/_SUCCESS`` or ``.../<study>.parquet``."""
    return F.regexp_extract(path, r"/([^/]+)\.parquet(?:/|$)", 1)


def data_type_of_path(path: Column) -> Column:
    """``molecular_trait`` before ``gwas``; any other path fails the query."""
    return (
        F.when(path.contains("molecular_trait"), F.lit("molecular_trait"))
        .when(path.contains("gwas"), F.lit("gwas"))
        .otherwise(
            F.raise_error(F.concat(F.lit("no data type in path: "), F.coalesce(path, F.lit("null"))))
        )
    )


def biobank_code(path: Column) -> Column:
    """Phenotype code from either of the two biobank file naming styles, else null."""
    name = base_name(path)
    mixed_model = dots_to_underscores(
        F.replace(
            F.substring_index(name, "_SAIGE_Nov2017", 1), F.lit("PheCode_"), F.lit("")
        )
    )
    linear_model = F.substring_index(name, ".neale2.", 1)
    return F.when(name.startswith("PheCode"), F.concat(F.lit("SAIGE_"), mixed_model)).when(
        name.contains(".neale2."), F.concat(F.lit("NEALE2_"), linear_model)
    )


def code_after(path: Column, marker: str, prefix: str) -> Column:
    """Text after the last ``marker`` up to the next dot, with a release prefix."""
    return F.concat(F.lit(prefix), before_first_dot(F.substring_index(path, marker, -1)))


def glob_of_split(path: Column) -> Column:
    """One glob for a file that was delivered in numbered pieces."""
    return F.replace(path, F.lit(".split000."), F.lit(".split*."))


def dataset_label(study: Column, bio_feature: Column) -> Column:
    return F.concat_ws("-", study, bio_feature)


def qtl_kind(label: Column) -> Column:
    return F.when(label.contains("sQTL"), F.lit("sQTL")).otherwise(F.lit("eQTL"))
