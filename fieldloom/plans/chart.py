"""A chart of scores by stage and of the funnel, as SVG text that depends on the numbers only, and fixed-width tables of a command line."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame

WIDTH, HEIGHT, LEFT, BAR = 640, 420, 150, 22
COLOURS = {"tier1": "#3b6ea5", "tier2": "#5b9a68", "tier3": "#c98a2d", "missed": "#a04a6a", "true_negative": "#9a9a9a"}


def _bar(y: int, label: str, part: float, text: str, colour: str) -> str:
    w = round((WIDTH - LEFT - 90) * max(0.0, min(1.0, part)), 1)
    return (
        f'<text x="{LEFT - 8}" y="{y + 15}" text-anchor="end">{escape(label)}</text><rect x="{LEFT}" y="{y}" width="{w}" height="{BAR}" fill="{colour}"/>'
        f'<text x="{LEFT + w + 6}" y="{y + 15}">{escape(text)}</text>'
    )


def caption(funnel: dict[str, int]) -> str:
    """What the funnel says, in a sentence."""
    cells = sum(funnel.values())
    return f"{cells} cells: {funnel['tier1']} settled by reader 1, {funnel['tier2']} by reader 2, {funnel['tier3']} by the strongest, {funnel['missed']} missed, {funnel['true_negative']} blank on the form."


def svg(scores: DataFrame, funnel: DataFrame, title: str = "") -> str:
    """Scores (stage, f1) and a funnel (one row of counts), each of few rows, as a chart."""
    stages = sorted((r["stage"], r["f1"]) for r in scores.select("stage", "f1").collect())
    counts = funnel.first().asDict()
    whole, out, y = max(1, sum(counts.values())), [f'<text x="12" y="24" font-size="16">{escape(title)}</text>'], 44
    for stage, f1 in stages:
        out.append(_bar(y, stage, f1, f"{f1:.3f}", "#3b6ea5"))
        y += BAR + 8
    y += 24
    for name, colour in COLOURS.items():
        out.append(_bar(y, name, counts[name] / whole, str(counts[name]), colour))
        y += BAR + 8
    out.append(f'<text x="12" y="{y + 24}" font-size="11">{escape(caption(counts))}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{WIDTH}" height="{HEIGHT}" font-family="sans-serif" font-size="13">{"".join(out)}</svg>'


def first_column(text: str) -> list[str]:
    """The first word of each line below the header of a fixed-width table; blank lines are left out."""
    return [line.split()[0] for line in text.splitlines()[1:] if line.strip()]


def under(text: str, header: str, row: str) -> str | None:
    """What stands under a header, up to the next one, in the line that begins with row; null where there is no such header or line, or nothing there."""
    lines = text.splitlines()
    at = lines[0].find(header) if lines else -1
    if at < 0:
        return None
    after = lines[0][at + len(header) :]
    end = at + len(header) + len(after) - len(after.lstrip()) if after.strip() else None
    found = next((line for line in lines[1:] if line.split()[:1] == [row]), "")
    return found[at:end].strip() or None
