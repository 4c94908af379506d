"""Four-column index pages: boxes to rows to places. Names carry over rows, columns and pages, so a volume's rows are folded in order."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .layout import Box, cluster_rows, column_starts

# A coordinate is degrees, perhaps minutes, perhaps a range, and a letter of direction.
DEGREES = r"\d{1,3}(?:[.,]\d{1,2})?(?:\s*[-–]\s*\d{1,3}(?:[.,]\d{1,2})?)?"
PAIR = re.compile(rf"({DEGREES})\s*([NS])\.?,?\s+({DEGREES})\s*([EW])\.?")
MOST_CARRIED = 3


def value_of(text: str) -> tuple[float, bool] | None:
    """(degrees, is a range) of DD.MM or a range of such; None where minutes reach 60."""
    ends = []
    for part in re.split(r"\s*[-–]\s*", text):
        d, _, m = part.replace(",", ".").partition(".")
        if int(m or 0) >= 60:
            return None
        ends.append(int(d) + int(m or 0) / 60)
    return sum(ends) / len(ends), len(ends) > 1


def split_boxes(lines: list[tuple[Box, str]], starts: list[int]) -> list[tuple[int, Box, str]]:
    """(column, box, text); a box that reaches well into the next column is cut after its first coordinate pair, the rest goes on there."""
    out = []
    for box, text in lines:
        col = max((k for k, s in enumerate(starts) if s <= box[0]), default=0)
        m = PAIR.search(text)
        if col + 1 < len(starts) and box[2] > starts[col + 1] + 18 and m and m.end() < len(text.rstrip()):
            out.append((col, (box[0], box[1], starts[col + 1], box[3]), text[: m.end()]))
            out.append((col + 1, (starts[col + 1], box[1], box[2], box[3]), text[m.end() :].strip()))
        else:
            out.append((col, box, text))
    return out


class Carry:
    """Names without a coordinate are held for the next row that has one; of more than three the last is kept."""

    def __init__(self):
        self.held: list[str] = []

    def feed(self, text: str) -> list[dict]:
        out, at = [], 0
        for m in PAIR.finditer(text):
            name = " ".join([*self.held, text[at : m.start()].strip(" ,.")]).strip()
            self.held, at = [], m.end()
            a, b = value_of(m[1]), value_of(m[3])
            if not name or a is None or b is None:
                continue
            lat, lon = a[0] * (-1 if m[2] == "S" else 1), b[0] * (-1 if m[4] == "W" else 1)
            if 0 <= lat <= 90 and 20 <= lon <= 180:
                place, _, province = name.rpartition(",")
                out.append({"name": (place or province).strip(), "province": province.strip() if place else None, "lat": lat, "lon": lon, "is_range": a[1] or b[1], "raw": text.strip()})
        if rest := text[at:].strip(" ,."):
            self.held.append(rest)
            if len(self.held) > MOST_CARRIED:
                self.held = self.held[-1:]
        return out


def parse_pages(pages: DataFrame, volume: str = "volume", page: str = "page") -> DataFrame:
    """pages: volume, page, w, lines array<struct<bbox,text>>. name, province, lat, lon, is_range, raw, page, col of every index row.

    A volume is one ordered fold (names run on over pages), volumes run apart.
    """
    kind = {c: pages.schema[c].dataType.simpleString() for c in (volume, page)}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        carry, out = Carry(), []
        for row in pdf.sort_values(page).itertuples(index=False):
            lines = [(tuple(x["bbox"]), x["text"] or "") for x in (row.lines if row.lines is not None else [])]
            starts, _ = column_starts([b[0] for b, _ in lines], row.w)
            cut = split_boxes(lines, starts)
            for col in range(len(starts)):
                inside = [(b, t) for c, b, t in cut if c == col]
                for r in cluster_rows([b for b, _ in inside], 0.55):
                    for found in carry.feed(" ".join(inside[i][1] for i in r)):
                        out.append({volume: getattr(row, volume), page: getattr(row, page), "col": col, **found})
        return pd.DataFrame(out, columns=[volume, page, "col", "name", "province", "lat", "lon", "is_range", "raw"])

    return pages.select(volume, page, "w", "lines").groupBy(volume).applyInPandas(run, f"`{volume}` {kind[volume]}, `{page}` {kind[page]}, col int, name string, province string, lat double, lon double, is_range boolean, raw string")


def stateless_rows(rows: DataFrame) -> DataFrame:
    """Rows that hold their own name and coordinate, without a fold: for indexes whose names never wrap."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([{"id": i, **x} for i, t in zip(pdf["id"], pdf["text"], strict=True) for x in Carry().feed(t or "")], columns=["id", "name", "province", "lat", "lon", "is_range", "raw"])

    return rows.select("id", "text").mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, name string, province string, lat double, lon double, is_range boolean, raw string")
