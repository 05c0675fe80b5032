"""Writers of bounded results: HTML, markdown, CSV and figures."""

from __future__ import annotations

import colorsys
import html
import math
import re
import struct
import zlib
from collections.abc import Callable
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame

MOST_ROWS = 100_000


def _rows(df: DataFrame, most: int) -> list:
    """All rows of a result for display; more than `most` raise, as they belong in a table."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows to display")
    return rows


STYLE = "table{border-collapse:separate;border-spacing:0}td,th{border-bottom:1px solid #ccc;padding:4px 8px;background:#fff;text-align:left}th{cursor:pointer;position:sticky;top:0}.fixed{position:sticky;z-index:1}mark{background:#fe6}"
SCRIPT = """
const body = document.querySelector('tbody'), all = [...body.rows], box = document.querySelector('input'), note = document.querySelector('output');
let found = all, page = 0, turn = 1, by = -1;
const text = (row, i) => row.cells[i].textContent, number = s => s.trim() === '' ? NaN : Number(s);
function show() {
  const pages = Math.max(1, Math.ceil(found.length / LENGTH));
  page = Math.min(Math.max(page, 0), pages - 1);
  body.replaceChildren(...found.slice(page * LENGTH, (page + 1) * LENGTH));
  note.textContent = `page ${page + 1} of ${pages}, ${found.length} of ${all.length} rows`;
  for (let i = 0, left = 0; i < FIXED; i++) {
    for (const row of document.querySelectorAll('tr')) row.cells[i].style.left = left + 'px';
    left += document.querySelectorAll('th')[i].offsetWidth;
  }
}
function search() {
  const words = box.value.toLowerCase().split(/\\s+/);
  found = all.filter(row => words.every(w => row.textContent.toLowerCase().includes(w)));
  if (by >= 0) found.sort((a, b) => {
    const x = text(a, by), y = text(b, by), d = number(x) - number(y);
    return turn * (isNaN(d) ? x.localeCompare(y) : d);
  });
  show();
}
box.oninput = () => { page = 0; search(); };
document.querySelectorAll('th').forEach((h, i) => h.onclick = () => { turn = by === i ? -turn : 1; by = i; search(); });
document.querySelectorAll('button').forEach((b, i) => b.onclick = () => { page += i ? 1 : -1; show(); });
show();
"""


def to_html(df: DataFrame, path: str, title: str = "", fixed_columns: int = 0, page_length: int = 50, most: int = MOST_ROWS, marked: tuple[str, ...] = ()) -> None:
    """A page that needs no other file: its table sorts by a click on a header, is searched, pages, and keeps the first columns in sight.

    Cells that are links stay links; in the columns `marked` the marks of grid.highlighted() stay marks; all else is escaped.
    """
    def cell(column: str, v) -> str:
        text = "" if v is None else str(v)
        if column in marked:
            return re.sub(r"&lt;(/?mark)&gt;", r"<\1>", html.escape(text))
        return text if re.fullmatch(r'<a href="[^"<>]*" target="_blank">[^<>]*</a>', text) else html.escape(text)

    def row(tag: str, cells: list[str]) -> str:
        return "<tr>" + "".join(f'<{tag}{" class=fixed" if i < fixed_columns else ""}>{c}</{tag}>' for i, c in enumerate(cells)) + "</tr>"

    body = "\n".join(row("td", [cell(c, v) for c, v in zip(df.columns, r)]) for r in _rows(df, most))
    script = SCRIPT.replace("LENGTH", str(page_length)).replace("FIXED", str(min(fixed_columns, len(df.columns))))
    Path(path).write_text(
        f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{html.escape(title)}</title><style>{STYLE}</style></head><body>"
        f'<p><input type=search placeholder=search> <button>&lt;</button> <button>&gt;</button> <output></output></p><table><thead>{row("th", [html.escape(c) for c in df.columns])}</thead><tbody>\n{body}\n</tbody></table>'
        f"<script>{script}</script></body></html>\n"
    )


def to_markdown(df: DataFrame, most: int = MOST_ROWS) -> str:
    def cell(v) -> str:
        return "NA" if v is None else str(v).replace("|", "\\|").replace("\n", " ")

    lines = [df.columns, ["---"] * len(df.columns), *[[cell(v) for v in r] for r in _rows(df, most)]]
    return "".join(f"| {' | '.join(x)} |\n" for x in lines)


def to_csv(df: DataFrame, path: str, most: int = 10 * MOST_ROWS) -> None:
    """One file for download; more rows than `most` raise, as they belong in a table."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one file")
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


WIDTH, HEIGHT, PAD = 1000, 600, 50


class Figure(NamedTuple):
    lines: list[tuple[str, tuple[int, int, int], list[tuple[float, float]]]]  # name, colour, points
    mark: float | None  # where a vertical line stands


def figure(points: DataFrame, series: str = "sm", x: str = "publication_year", y: str = "n", mark: int | None = 2019, most: int = MOST_ROWS) -> Figure:
    """A line a series over years, on a logarithmic scale, with a mark at a year."""
    rows = sorted(_rows(points.select(series, x, y).where(f"{y} > 0 and {x} is not null"), most), key=lambda r: (str(r[0]), r[1]))
    years, logs = [r[1] for r in rows] or [0], [math.log10(r[2]) for r in rows] or [0]
    across = (WIDTH - 2 * PAD) / max(1, max(years) - min(years))
    up = (HEIGHT - 2 * PAD) / max(1e-9, max(logs) - min(logs))
    by_series: dict[str, list[tuple[float, float]]] = {}
    for r in rows:
        by_series.setdefault(str(r[0]), []).append((PAD + (r[1] - min(years)) * across, HEIGHT - PAD - (math.log10(r[2]) - min(logs)) * up))
    colours = [tuple(round(255 * c) for c in colorsys.hls_to_rgb(i / max(1, len(by_series)), 0.45, 0.6)) for i in range(len(by_series))]
    at = PAD + (mark - min(years)) * across if mark is not None and min(years) <= mark <= max(years) else None
    return Figure([(s, c, p) for (s, p), c in zip(by_series.items(), colours)], at)


def svg(f: Figure) -> bytes:
    parts = [f'<polyline fill="none" stroke="rgb{c}" points="{" ".join(f"{a:.1f},{b:.1f}" for a, b in p)}"><title>{html.escape(s)}</title></polyline>' for s, c, p in f.lines]
    if f.mark is not None:
        parts.append(f'<line x1="{f.mark:.1f}" x2="{f.mark:.1f}" y1="{PAD}" y2="{HEIGHT - PAD}" stroke="black"/>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{WIDTH}" height="{HEIGHT}">{"".join(parts)}</svg>\n'.encode()


def pdf(f: Figure) -> bytes:
    """One page of lines; a PDF's y axis points up."""
    strokes = [(c, p) for _, c, p in f.lines] + ([((0, 0, 0), [(f.mark, PAD), (f.mark, HEIGHT - PAD)])] if f.mark is not None else [])
    draw = "\n".join(" ".join(f"{v / 255:.3f}" for v in c) + " RG " + " ".join(f"{a:.1f} {HEIGHT - b:.1f} {'l' if i else 'm'}" for i, (a, b) in enumerate(p)) + " S" for c, p in strokes).encode()
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %d %d] /Contents 4 0 R /Resources << >> >>" % (WIDTH, HEIGHT),
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(draw), draw),
    ]
    out, places = b"%PDF-1.4\n", []
    for n, o in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, o)
    table = b"".join(b"%010d 00000 n \n" % p for p in places)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, table, len(objects) + 1, len(out))


def png(f: Figure) -> bytes:
    """Lines drawn pixel by pixel."""
    rows = [bytearray(b"\xff" * (3 * WIDTH)) for _ in range(HEIGHT)]
    strokes = [(c, p) for _, c, p in f.lines] + ([((0, 0, 0), [(f.mark, PAD), (f.mark, HEIGHT - PAD)])] if f.mark is not None else [])
    for c, p in strokes:
        for (a, b), (x, y) in zip(p, p[1:] or p):
            steps = max(1, math.ceil(max(abs(x - a), abs(y - b))))
            for i in range(steps + 1):
                px, py = round(a + (x - a) * i / steps), round(b + (y - b) * i / steps)
                rows[min(py, HEIGHT - 1)][3 * px : 3 * px + 3] = bytes(c)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    data = zlib.compress(b"".join(b"\0" + bytes(r) for r in rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, HEIGHT, 8, 2, 0, 0, 0)) + chunk(b"IDAT", data) + chunk(b"IEND", b"")


WRITERS = {".svg": svg, ".pdf": pdf, ".png": png}


def to_figure(points: DataFrame, *paths: str, **options) -> None:
    """The figure, by each path's suffix as .svg, .pdf or .png."""
    drawn = figure(points, **options)
    for p in map(Path, paths):
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(WRITERS[p.suffix](drawn))


def to_figure_once(points: Callable[[], DataFrame], *paths: str, **options) -> bool:
    """As to_figure(), unless all files are there already; says whether it drew."""
    if all(Path(p).exists() for p in paths):
        return False
    to_figure(points(), *paths, **options)
    return True
