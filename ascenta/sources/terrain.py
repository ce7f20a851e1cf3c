"""Terrain windows over HTTP: requests, retries and checks; the fetcher is given, so tests need no network."""

from __future__ import annotations

import time
import urllib.parse
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Seconds before the second attempt; doubled for each further one.
BACKOFF_S = 1.0
TIFF_MAGIC = (b"II*\x00", b"MM\x00*")


def window_url(service: str, box: tuple[int, int, int, int], pixels: int, epsg: int = 5514) -> str:
    """The export request of a window: its box in metres and its size in pixels."""
    asked = {"bbox": ",".join(map(str, box)), "bboxSR": epsg, "imageSR": epsg, "size": f"{pixels},{pixels}", "format": "tiff", "pixelType": "F32", "f": "image"}
    return f"{service}?{urllib.parse.urlencode(asked)}"


def fetch_window(get: Callable[[str], tuple[bytes, int | None]], url: str, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """A window's bytes; *get* gives bytes and the length that was announced. Truncated or foreign replies are tried again."""
    wrong = ""
    for attempt in range(attempts):
        if attempt:
            sleep(BACKOFF_S * 2 ** (attempt - 1))
        try:
            data, announced = get(url)
        except OSError as e:
            wrong = str(e)
            continue
        if announced is not None and len(data) != announced:
            wrong = f"{len(data)} of {announced} bytes"
        elif not data.startswith(TIFF_MAGIC):
            wrong = "no TIFF"
        else:
            return data
    raise OSError(f"dem: {url}: {wrong}")


def window_faults(found: dict, wanted: dict) -> list[str]:
    """All ways in which a window's header differs from what was asked: size, pixel, origin, crs, type, nodata, area, block."""
    return [f"{k} is {found.get(k)!r}, not {v!r}" for k, v in wanted.items() if found.get(k) != v]


def fetch_tiles(tiles: DataFrame, get: Callable[[str], tuple[bytes, int | None]], service: str, span: int, pixels: int) -> DataFrame:
    """Tiles (tx, ty) with their url, bytes and sha256; each partition fetches its own."""

    def kernel(batches: Iterable):
        import pandas as pd

        for pdf in batches:
            rows = []
            for tx, ty in zip(pdf["tx"], pdf["ty"], strict=True):
                url = window_url(service, (tx * span, ty * span, (tx + 1) * span, (ty + 1) * span), pixels)
                rows.append((tx, ty, url, fetch_window(get, url)))
            yield pd.DataFrame(rows, columns=["tx", "ty", "url", "data"])

    return tiles.mapInPandas(kernel, "tx long, ty long, url string, data binary").withColumn("sha256", F.sha2("data", 256))
