"""Markdown of small aggregates, made on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence


def table(head: Sequence[str], rows: Iterable[Sequence]) -> str:
    lines = ["| " + " | ".join(head) + " |", "|" + "|".join(["---"] * len(head)) + "|"]
    return "\n".join([*lines, *("| " + " | ".join("—" if x is None else str(x) for x in row) + " |" for row in rows)])


def quality(keys: Mapping, dips: int, known_dips: int, confirmed: int, unknown: int) -> str:
    figures = [
        ("keys from", keys["kleinste"]), ("keys to", keys["groesste"]), ("numeric keys", keys["anzahl"]), ("gaps", keys["luecken"]), ("repeated keys", keys["dubletten"]),
        ("out of alphabetical order", dips), ("of these uncertain already", known_dips), ("in the register", confirmed), ("not in the register", unknown),
    ]
    return "# Quality\n\n" + table(["check", "rows"], figures) + "\n"


def survey(years: Sequence, months: Sequence, cutoff: str, total: int, usable: int, concordance: tuple[int, int, int], review: int) -> str:
    rows, unique, with_suffix = concordance
    figures = [("streets", total), ("usable", usable), ("left out as uncertain", total - usable), ("concordance rows", rows), ("unique", unique), ("colliding", rows - unique), ("with suffix", with_suffix), ("to review", review)]
    method = (
        "A rename counts for the earlier or the later name if the address book holds that one alone. Stages without a readable date are skipped, "
        "never estimated; the months count stages dated to the day alone. The concordance is made of usable streets; chains that don't end in their "
        "street's name go to the review list, and names that several streets had are marked as colliding."
    )
    parts = [f"# State of names at {cutoff}", method, table(["figure", "rows"], figures)]
    for title, found in (("by year", years), ("by month", months)):
        parts += [f"## Renames {title}", table(["period", "only the earlier name", "only the later name"], [(r["period"], r["alt"], r["neu"]) for r in found])]
    return "\n\n".join(parts) + "\n"


def error_rates(total: int, done: int, rates: Sequence, errors: Sequence) -> str:
    rows = [(r["ebene"], r["gruppe"], r["geprueft"], r["korrekt"], f"{r['fehlerquote']:.1f} %") for r in rates]
    wrong = [(r["schl_nr"], r["lemma"], r["feld"], r["wert"], r["korrektur"]) for r in errors]
    parts = [f"# Checked sample\n\n{done} of {total} rows checked.", table(["level", "group", "checked", "right", "error rate"], rows), "## Errors", table(["key", "lemma", "field", "value", "correction"], wrong)]
    return "\n\n".join(parts) + "\n"


def changes(counts: Mapping[str, int]) -> str:
    return "# Changes\n\n" + table(["category", "rows"], counts.items()) + "\n"


def image_index(rows: Sequence) -> str:
    return table(["key", "page", "fields", "image"], [(r["schl_nr"], r["buchseite"], ", ".join(r["felder"]), f"schlnr_{r['schl_nr']}_s{r['buchseite']:03d}.png") for r in rows]) + "\n"
