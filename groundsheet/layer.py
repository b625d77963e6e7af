"""The layer record: a DataFrame, its geometry column and what is known about both."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GEOMETRY_NAMES = ("geometry", "geom")


@dataclass
class Layer:
    """``box`` names numeric columns (xmin, ymin, xmax, ymax) that bound each geometry.

    With them spatial filters become plain column comparisons that reach the Parquet
    scan, and joins find candidates without decoding a geometry.
    """

    name: str
    df: DataFrame
    geom: str | None = None
    crs: int = 4326
    box: tuple[str, str, str, str] | None = None
    aliases: dict[str, str] = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        return [c for c in self.df.columns if c != self.geom]


def find_geometry(df: DataFrame) -> str | None:
    """Geometry column: by name first, else the first binary column that holds WKB."""
    for name, kind in df.dtypes:
        if name.lower() in GEOMETRY_NAMES and kind == "binary":
            return name
    for name, kind in df.dtypes:
        if kind != "binary":
            continue
        # byte order mark (0 or 1), then a geometry kind from 1 to 7
        head = F.hex(F.substring(name, 1, 5))
        row = df.where(F.col(name).isNotNull()).select(head).first()
        if row and row[0][:2] in ("00", "01"):
            word = bytes.fromhex(row[0][2:])
            code = int.from_bytes(word, "big" if row[0][:2] == "00" else "little")
            if len(word) == 4 and 1 <= code % 1000 & 0xFF <= 7:
                return name
    return None


def as_layer(df: DataFrame, name: str = "layer", crs: int = 4326, box=None) -> Layer:
    return Layer(name, df, find_geometry(df), crs, box)
