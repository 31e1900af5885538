"""Readers: CSV in its variants, parquet, loop files, HTML rows, generated columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.skew import attach

_FLAGS = re.IGNORECASE | re.DOTALL | re.ASCII


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    sep: str = ",",
    multiline: bool = False,
    infer: bool = False,
) -> DataFrame:
    """CSV with header; quotes inside quoted fields are doubled, so JSON survives.

    ``multiline`` makes a file unsplittable: use it only where fields hold newlines,
    and write such tables as many files.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    )
    if multiline:
        reader = reader.option("multiLine", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def _column_like(header: Column, word: str) -> Column:
    return F.array_position(F.transform(header, lambda c: c.contains(word)), F.lit(True))


def read_loop_files(spark: SparkSession, path: str, id_pattern: str) -> DataFrame:
    """One signal per file (or folder): (loop_id, t, pv, sp, op).

    The id comes from the path. Every file has its own header; the columns are
    found by the words time, pv, sp and op in it. The header lines (one per file)
    are joined to the data lines of their file, so files with any number of
    different headers are read in one job. Time may have fractions; lines of a file without such a header keep their id
    and are NULL otherwise, so no file goes unseen.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    lowered = F.lower("value")
    is_header = lowered.contains("pv") & lowered.contains("sp") & lowered.contains("op")
    header = F.split(lowered, ",")
    places = (
        lines.filter(is_header)
        .select("file", *[_column_like(header, w).alias(f"_{w}") for w in ("time", "pv", "sp", "op")])
        .distinct()
    )
    cells = lines.filter(~is_header & (F.length(F.trim("value")) > 0)).select(
        "file", F.split("value", ",").alias("cells")
    )

    def cell(word: str, kind: str) -> Column:
        return F.try_element_at("cells", F.nullif(F.col(f"_{word}").cast("int"), F.lit(0))).try_cast(kind)

    return attach(cells, places, ["file"], "left").select(
        F.regexp_extract("file", id_pattern, 1).cast("long").alias("loop_id"),
        cell("time", "double").alias("t"),
        *[cell(w, "double").alias(w) for w in ("pv", "sp", "op")],
    )


def html_field(html: Column, tag: str) -> Column:
    """Inner text of the first such tag, NULL if there is none."""
    return F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1), F.lit(""))


def class_elements(page: str, tag: str, css_class: str) -> list[str]:
    """The inside of every ``tag`` that has the class, alone or among others, wherever the attribute
    stands and however it is quoted; elements inside a found one belong to it. A closing tag closes
    the last open one, so depth and length have no limit; an element left open is none."""
    named = re.compile(rf"""<{tag}\b[^>]*?\bclass\s*=\s*["']?(?:[^"'>]*\s)?{css_class}(?=[\s"'>])[^>]*>""", _FLAGS)
    opened, found, at = [], [], 0
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])", page, _FLAGS):
        if m.start() < at:
            continue
        at = page.find(">", m.end()) + 1
        if not at:
            break
        if not m[1]:
            opened.append((at, bool(named.match(page, m.start(), at))))
        elif opened:
            start, ours = opened.pop()
            if ours:
                while found and found[-1][0] > start:
                    found.pop()
                found.append((start, m.start()))
    return [page[a:b] for a, b in found]


def _elements(html: Column, tag: str, css_class: str) -> Column:
    @F.pandas_udf("array<string>")
    def elements(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else class_elements(page, tag, css_class))

    return elements(html)


def _plain(inner: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(inner, r"<[^>]*>", "")), F.lit(""))


def html_class_text(html: Column, tag: str, css_class: str) -> Column:
    """Text of the first ``tag`` of a class, inner tags removed."""
    return _plain(F.get(_elements(html, tag, css_class), F.lit(0)))


def html_elements(df: DataFrame, html: str, tag: str, css_class: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per ``tag`` of a class: ``element`` (0, 1, ...), its ``text``, and per field the text of
    the first ``(tag, class)`` inside it; the repeated cards of a listing page."""
    found = _elements(F.col(html), tag, css_class)
    rows = df.select(*[c for c in df.columns if c != html], F.posexplode(found).alias("element", "_inner"))
    inner = [html_class_text(F.col("_inner"), t, c).alias(n) for n, (t, c) in fields.items()]
    return rows.select("*", _plain(F.col("_inner")).alias("text"), *inner).drop("_inner")


def html_first_attr(html: Column, tag: str, attr: str) -> Column:
    """An attribute of the first such tag, such as the ``alt`` of the first image."""
    return F.nullif(F.regexp_extract(html, rf'(?is)<{tag}\b[^>]*?\b{attr}="([^"]*)"', 1), F.lit(""))


def html_links(df: DataFrame, html: str, suffix: str, out: str = "href") -> DataFrame:
    """One row per link whose target ends with ``suffix``."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    links = F.transform(found, lambda x: F.regexp_replace(x, """^["']|["']$""", ""))
    return df.withColumn(out, F.explode(links)).filter(F.col(out).endswith(suffix))


def synthetic_table(keys: DataFrame, key: str, seed: int, threshold: float = 0.5) -> DataFrame:
    """Uniform, normal and binary columns drawn per key row.

    The draws are hashes of key and seed, so a retried task makes the same rows
    however the table is partitioned; the normal column is Box-Muller.
    """

    def uniform(salt: int) -> Column:
        # Multiplicative hashing with the golden-ratio and a second odd constant.
        mixed = (F.col(key) % 1048576 + F.lit(seed * 7919 + salt)) * F.lit(2654435761) % 4294967296
        again = (mixed % 1048576) * F.lit(40503) + F.floor(mixed / 1048576)
        return (again % 1000003 + 1) / F.lit(1000004.0)

    u1, u2 = uniform(1), uniform(2)
    normal = F.sqrt(-2 * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
    return keys.select(
        key,
        u1.alias("uniform"),
        normal.alias("normal"),
        (u2 > threshold).cast("int").alias("flag"),
    )
