"""Airport traffic report: an HTML table saved as .xls, with a two-row header and subtotal rows."""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.casts import to_date, to_num

CELL = r"(?is)<t[dh]([^>]*)>(.*?)</t[dh]>"
TAG = r"<[^>]+>"
COLSPAN = r"(?i)colspan\s*=\s*[\"']?(\d{1,3})"


def read_report_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header rows and body rows of the reports, each (file, place, cells): a cell spanning n columns counts n times.

    ``</tr>`` is the record separator, so a large report is split between tasks like any text file.
    """
    lines = spark.read.option("lineSep", "</tr>").text(path)
    span = lambda a: F.coalesce(F.try_to_number(F.regexp_extract(a, COLSPAN, 1), F.lit("999")).cast("int"), F.lit(1))
    spans = F.transform(F.regexp_extract_all("value", F.lit(CELL), F.lit(1)), span)
    texts = F.transform(
        F.regexp_extract_all("value", F.lit(CELL), F.lit(2)),
        lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, TAG, ""), "&nbsp;|\u00a0", " ")),
    )
    cells = F.flatten(F.transform(F.arrays_zip(texts.alias("t"), spans.alias("n")), lambda c: F.array_repeat(c["t"], c["n"])))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = lines.select(
        F.col("_metadata.file_path").alias("file"), place.alias("place"), F.lower("value").contains("<th").alias("head"), cells.alias("cells")
    ).where(F.size("cells") > 0)
    return rows.where("head"), rows.where("not head")


def flatten_header(levels: list[list[str]]) -> list[str]:
    """Column names ``upper_lower`` from the cells of the header rows."""
    return ["_".join(part for part in parts if part) for parts in zip_longest(*levels, fillvalue="")]


def _positions(names: list[str]) -> tuple[int, int, int]:
    """Places of date, facility and total among the flattened names."""
    tests = (lambda c: c.endswith("_Date"), lambda c: c.endswith("_Facility"), lambda c: "Total Operations" in c)
    found = [next((i for i, c in enumerate(names) if test(c)), None) for test in tests]
    if None in found:
        raise KeyError(f"no such column among {names}")
    return tuple(found)


def read_traffic_report(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned reports: (date, airport, airport_operations), one row for each airport and day.

    Each file is read by its own header, two rows; one without a header, such as a later part of a report, by the
    first file's. Cells are taken by their place, so a row with a cell too many or too few
    is kept. Where files overlap, the larger count of an airport's day is taken.
    """
    head, body = read_report_rows(spark, path)
    headers: dict[str, list] = {}
    for row in sorted(head.collect(), key=lambda r: (r["file"], r["place"])):  # two rows for each file
        headers.setdefault(row["file"], []).append(row["cells"])
    places = [(file, *_positions(flatten_header(levels[:2]))) for file, levels in sorted(headers.items())]
    if not places:
        raise KeyError(f"no header in {path}")
    by_file = spark.createDataFrame(places, "file string, d int, f int, t int")
    place = {c: F.coalesce(c, F.lit(n)) for c, n in zip("dft", places[0][1:])}
    cells = body.join(by_file, "file", "left").select(
        F.get("cells", place["d"]).alias("x_Date"), F.get("cells", place["f"]).alias("x_Facility"), F.get("cells", place["t"]).alias("Total Operations")
    )
    return clean_traffic_report(cells).groupBy("date", "airport").agg(F.max("airport_operations").alias("airport_operations"))


def clean_traffic_report(raw: DataFrame) -> DataFrame:
    """Pick date, facility and total from flattened text columns; drop subtotals and rows without a real date."""

    def pick(test) -> str:
        found = [c for c in raw.columns if test(c)]
        if not found:
            raise KeyError(f"no such column among {raw.columns}")
        return found[0]

    date = pick(lambda c: c.endswith("_Date"))
    facility = pick(lambda c: c.endswith("_Facility"))
    total = pick(lambda c: "Total Operations" in c)
    rows = raw.select(
        F.trim(F.col(f"`{date}`")).alias("day"),
        F.trim(F.col(f"`{facility}`")).alias("airport"),
        F.regexp_replace(F.col(f"`{total}`"), ",", "").alias("count"),
    )
    kept = rows.where(~F.coalesce(F.col("day").contains("Total"), F.lit(False)))
    return kept.select(
        to_date("day", "MM/dd/yyyy").alias("date"), "airport", to_num("count").alias("airport_operations")
    ).where("date is not null")
