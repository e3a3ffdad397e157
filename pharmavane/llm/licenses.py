"""License scans by ordered signature rules.

A rule is a label, its keywords, a pattern and a priority. Literal search comes
first: only a rule whose keywords all occur runs its pattern. Keywords are single
words, since the pattern takes any separators between words. Detections then
resolve by priority: one that lies within a detection of higher priority (or
of equal priority and greater length) is suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"  # what separates words
EDGE, END = r"(?<![0-9a-z\x80-\xff])", r"(?![0-9a-z\x80-\xff])"

# Fixed by contract: phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Hand-written families: label, words that any match of the name holds, name as a
# pattern over words ('~' is a gap), and further phrases that only this license uses.
# A phrase with ' ... ' has a name of any length between its two ends.
FAMILIES: list[tuple[str, str, str, list[str]]] = [
    ("mit", "expat", "(?:the~)?expat", []),
    ("mit", "mit", "(?:the~)?mit", ["permission~is~hereby~granted~free~of~charge~to~any~person~obtaining~a~copy"]),
    ("mit-0", "mit", "mit~(?:no~attribution|0)", []),
    ("apache-1.1", "apache", "apache(?:~software)?~(?:license~)?(?:version~|v)?1~1", []),
    ("apache-2.0", "apache", "apache(?:~software)?~(?:license~)?(?:version~|v)?2(?:~0)?", ["licensed~under~the~apache~license", "apache~org~licenses~license~2~0"]),
    ("gpl-1.0", "gpl", "(?:gnu~)?gpl~?(?:version~|v)?1(?:~0)?", []),
    ("gpl-2.0", "gpl", "(?:gnu~)?gpl~?(?:version~|v)?2(?:~0)?", ["gnu~org~licenses~old~licenses~gpl~2~0"]),
    ("gpl-3.0", "gpl", "(?:gnu~)?gpl~?(?:version~|v)?3(?:~0)?", ["gnu~org~licenses~gpl~3~0"]),
    ("gpl-2.0", "general public", "(?:gnu~)?general~public~license~(?:as~published~by~the~free~software~foundation~)?(?:either~)?version~2", []),
    ("gpl-3.0", "general public", "(?:gnu~)?general~public~license~(?:as~published~by~the~free~software~foundation~)?(?:either~)?version~3", []),
    ("lgpl-2.0", "lgpl", "(?:gnu~)?lgpl~?(?:version~|v)?2(?:~0)?", []),
    ("lgpl-2.1", "lgpl", "(?:gnu~)?lgpl~?(?:version~|v)?2~1", []),
    ("lgpl-3.0", "lgpl", "(?:gnu~)?lgpl~?(?:version~|v)?3(?:~0)?", []),
    ("lgpl", "lesser general", "(?:gnu~)?lesser~general~public", ["gnu~lesser~general~public~license"]),
    ("lgpl", "library general", "(?:gnu~)?library~general~public", []),
    ("agpl-3.0", "agpl", "(?:gnu~)?agpl~?(?:version~|v)?3?(?:~0)?", []),
    ("agpl-3.0", "affero", "(?:gnu~)?affero~general~public", ["remote~network~interaction~use~with~the~gnu~general~public~license"]),
    ("bsd-0-clause", "clause", "(?:bsd~)?(?:zero|0)~clause(?:~bsd)?", []),
    ("bsd-1-clause", "clause", "(?:bsd~)?1~clause(?:~bsd)?", []),
    ("bsd-2-clause", "bsd", "(?:simplified~bsd|freebsd|bsd~2~clause|2~clause~bsd)", []),
    ("bsd-3-clause", "bsd", "(?:new~bsd|modified~bsd|bsd~3~clause|3~clause~bsd)", []),
    ("bsd-4-clause", "bsd", "(?:original~bsd|old~bsd|bsd~4~clause|4~clause~bsd)", []),
    ("bsd", "bsd style", "bsd~style", ["redistribution~and~use~in~source~and~binary~forms~with~or~without~modification"]),
    ("bsd-3-clause", "endorse", "bsd~no~endorsement", ["neither~the~name~of ... nor~the~names~of~its~contributors"]),
    ("mpl-1.1", "mozilla", "mozilla~public~(?:license~)?(?:version~|v)?1~1", []),
    ("mpl-2.0", "mozilla", "mozilla~public(?:~license)?(?:~version|~v)?(?:~2~0)?", ["subject~to~the~terms~of~the~mozilla~public~license"]),
    ("mpl-2.0", "mpl", "mpl~?(?:version~|v)?2(?:~0)?", []),
    ("epl-1.0", "eclipse", "eclipse~public~(?:license~)?(?:version~|v)?1(?:~0)?", []),
    ("epl-2.0", "eclipse", "eclipse~public~(?:license~)?(?:version~|v)?2(?:~0)?", ["eclipse~org~legal~epl~2~0"]),
    ("edl-1.0", "eclipse", "eclipse~distribution", []),
    ("cddl-1.0", "cddl", "cddl(?:~1~0)?", []),
    ("cddl-1.0", "common development", "common~development~and~distribution", []),
    ("cpl-1.0", "common public", "common~public", []),
    ("ipl-1.0", "ibm public", "ibm~public", []),
    ("isc", "isc", "isc", []),
    ("isc", "internet systems consortium", "internet~systems~consortium", ["permission~to~use~copy~modify~and~or~distribute~this~software~for~any~purpose"]),
    ("zlib", "zlib", "zlib(?:~libpng)?", []),
    ("zlib", "zlib", "zlib~text", ["this~software~is~provided~as~is~without~any~express~or~implied~warranty~in~no~event"]),
    ("libpng", "libpng", "libpng", []),
    ("bsl-1.0", "boost", "boost(?:~software)?", ["boost~org~license~1~0"]),
    ("busl-1.1", "business source", "business~source", []),
    ("unlicense", "unlicense", "(?:the~)?unlicense", ["this~is~free~and~unencumbered~software~released~into~the~public~domain"]),
    ("wtfpl", "wtfpl", "wtfpl", []),
    ("wtfpl", "what the f", "do~what~the~f[a-z]+~you~want~to~public", []),
    ("cc0-1.0", "cc0", "cc0(?:~1~0)?(?:~universal)?", []),
    ("cc0-1.0", "creative commons", "creative~commons~zero", ["creativecommons~org~publicdomain~zero"]),
    ("cc-by-3.0", "creative commons", "creative~commons~attribution~3~0", []),
    ("cc-by-4.0", "creative commons", "creative~commons~attribution(?:~4~0)?(?:~international)?", ["creativecommons~org~licenses~by~4~0"]),
    ("cc-by-sa-3.0", "creative commons", "creative~commons~attribution~share~?alike~3~0", []),
    ("cc-by-sa-4.0", "creative commons", "creative~commons~attribution~share~?alike(?:~4~0)?", ["creativecommons~org~licenses~by~sa~4~0"]),
    ("cc-by-nc-4.0", "creative commons", "creative~commons~attribution~non~?commercial(?:~4~0)?", ["creativecommons~org~licenses~by~nc~4~0"]),
    ("cc-by-nd-4.0", "creative commons", "creative~commons~attribution~no~?deriv[a-z]+(?:~4~0)?", ["creativecommons~org~licenses~by~nd~4~0"]),
    ("cc-by-4.0", "cc by", "cc~by~4~0", []),
    ("cc-by-sa-4.0", "cc by", "cc~by~sa~4~0", []),
    ("cc-by-nc-4.0", "cc by", "cc~by~nc~4~0", []),
    ("artistic-1.0", "artistic", "artistic~(?:license~)?(?:version~)?1(?:~0)?", []),
    ("artistic-2.0", "artistic", "artistic(?:~2~0)?", []),
    ("psf-2.0", "python", "python~software~foundation", ["psf~license~agreement"]),
    ("php-3.01", "php", "php(?:~3~01)?", []),
    ("ruby", "ruby", "ruby", []),
    ("postgresql", "postgresql", "postgresql", []),
    ("openssl", "openssl", "openssl", ["developed~by~the~openssl~project"]),
    ("ssleay", "ssleay", "(?:original~)?ssleay", []),
    ("ofl-1.1", "open font", "(?:sil~)?open~font", []),
    ("osl-3.0", "open software", "open~software~(?:license~)?3~0", []),
    ("afl-3.0", "academic free", "academic~free", []),
    ("ms-pl", "microsoft", "microsoft~public", []),
    ("ms-rl", "microsoft", "microsoft~reciprocal", []),
    ("eupl-1.2", "european union", "european~union~public", []),
    ("eupl-1.2", "eupl", "eupl(?:~1~2)?", []),
    ("upl-1.0", "universal permissive", "universal~permissive", []),
    ("ncsa", "ncsa", "(?:university~of~illinois~)?ncsa(?:~open~source)?", []),
    ("vim", "vim", "vim", []),
    ("x11", "x11", "x11", []),
    ("w3c", "w3c", "w3c(?:~software)?", []),
    ("beerware", "beer", "beer~?ware", []),
    ("json", "json", "json", ["the~software~shall~be~used~for~good~not~evil"]),
    ("icu", "icu", "icu", []),
    ("unicode", "unicode", "unicode(?:~inc)?", []),
    ("intel", "intel", "intel~open~source", []),
    ("qpl-1.0", "q public", "q~public", []),
    ("apsl-2.0", "apple public", "apple~public~source", []),
    ("bittorrent", "bittorrent", "bittorrent~open~source", []),
    ("sspl-1.0", "server side", "server~side~public", []),
    ("elastic-2.0", "elastic", "elastic(?:~2~0)?", []),
    ("odbl-1.0", "open database", "open~database", []),
    ("odc-by-1.0", "open data", "open~data~commons~attribution", []),
    ("mulan-2.0", "mulan", "mulan~(?:permissive~)?(?:software~)?", []),
    ("openrail", "openrail", "(?:creativeml~|bigscience~)?openrail(?:~m)?", []),
    ("gfdl-1.3", "free documentation", "(?:gnu~)?free~documentation", []),
    ("public-domain", "public domain", "public~domain", ["(?:released|placed|dedicated)~(?:in|into|to)~the~public~domain"]),
    ("proprietary", "all rights", "all~rights~reserved", ["all~rights~reserved"]),
]

# Templates that make the rules of a family: a literal that any match holds, the
# pattern around the name, priority, weight.
TEMPLATES: list[tuple[str, str, int, float]] = [
    ("spdx", "spdx~license~identifier~{n}{e}", 95, 1.0),
    ("licensed", "licensed~under~(?:the~)?(?:terms~of~(?:the~)?)?{n}(?:~license)?{e}", 80, 0.95),
    ("released", "released~under~(?:the~)?(?:terms~of~(?:the~)?)?{n}(?:~license)?{e}", 75, 0.9),
    ("distributed", "distributed~under~(?:the~)?(?:terms~of~(?:the~)?)?{n}(?:~license)?{e}", 75, 0.9),
    ("available", "available~under~(?:the~)?(?:terms~of~(?:the~)?)?{n}(?:~license)?{e}", 75, 0.9),
    ("licen", "(?:under|by)~the~{n}~licen[sc]e{e}", 65, 0.85),
    ("licen", "{n}~licen[sc]e[sd]?{e}", 60, 0.7),
    ("licen", "licen[sc]e~(?:is~)?{n}{e}", 55, 0.6),
]
PHRASE_PRIORITY, PHRASE_WEIGHT = 90, 0.95


class Rule(NamedTuple):
    label: str
    anchor: bytes  # tried first; shared by many rules
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    priority: int
    weight: float
    opening: re.Pattern | None = None  # of a phrase of two ends; the pattern is its last

    def spans(self, text: bytes) -> Iterator[tuple[int, int]]:
        """The matches. A last end goes with the nearest first end, if in its sentence."""
        closings = [m.span() for m in self.pattern.finditer(text)]
        if not self.opening or not closings:
            yield from closings
            return
        openings, at = [m.span() for m in self.opening.finditer(text)], 0
        for start, end in closings:
            first = None
            while at < len(openings) and openings[at][1] <= start:
                first, at = openings[at], at + 1
            if first and not _OTHER.search(text, first[1], start):
                yield first[0], end


def _pattern(words: str) -> re.Pattern:
    spelled = words.replace("~?", f"(?:{GAP})?").replace("~", GAP)
    return re.compile((EDGE + spelled).encode("latin-1"))


_OTHER = _pattern("(?:neither|nor~the~names?)" + END)  # in no name; begins or ends another clause


@cache
def rules() -> tuple[Rule, ...]:
    """Several hundred rules: every family in every template, and its own phrases.

    The anchor of a phrase is the longest plain word (of its last end, if it has two).
    """
    made = []
    for label, keyword, name, phrases in FAMILIES:
        made += [
            Rule(label, anchor.encode(), tuple(keyword.encode().split()), _pattern(around.format(n=name, e=END)), priority, weight)
            for anchor, around, priority, weight in TEMPLATES
        ]
        for phrase in phrases:
            *opening, closing = phrase.split(" ... ")
            anchor = max((w for w in closing.split("~") if w.isalpha()), key=len).encode()
            first = _pattern(opening[0] + END) if opening else None
            made.append(Rule(label, anchor, (), _pattern(closing + END), PHRASE_PRIORITY, PHRASE_WEIGHT, first))
    return tuple(sorted(made, key=lambda rule: -rule.priority))


@cache
def _gate() -> dict[bytes, dict[tuple[bytes, ...], list[Rule]]]:
    """Rules by anchor, then by keywords."""
    found: dict[bytes, dict[tuple[bytes, ...], list[Rule]]] = {}
    for rule in rules():
        found.setdefault(rule.anchor, {}).setdefault(rule.keywords, []).append(rule)
    return found


@cache
def _base_patterns() -> tuple[tuple[str, re.Pattern], ...]:
    return tuple((label, _pattern(phrase.replace(" ", "~") + END)) for phrase, label in BASE.items())


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int
    weight: float


def _resolve(found: list[Detection]) -> list[Detection]:
    """Detections not contained in one that outranks them.

    Ranked ones are taken in turn; kept ones are swept by start with the greatest
    end so far, for each priority, so that containment is a look-up.
    """
    kept: list[Detection] = []
    ranked = sorted(found, key=lambda d: (d.start, -d.end, -d.priority, d.label))
    reach: dict[int, int] = {}  # priority -> greatest end of a detection that starts no later
    for d in ranked:
        if not any(end >= d.end for priority, end in reach.items() if priority >= d.priority):
            kept.append(d)
        reach[d.priority] = max(d.end, reach.get(d.priority, 0))
    return kept


def detect(text: bytes) -> list[Detection]:
    """The detections that remain in a lower-cased text, by start."""
    found = [
        Detection(*span, rule.label, rule.priority, rule.weight)
        for anchor, by_keywords in _gate().items()
        if anchor in text
        for keywords, gated in by_keywords.items()
        if all(word in text for word in keywords)
        for rule in gated
        for span in rule.spans(text)
    ]
    return _resolve(found) if found else found


_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans array<struct<start:long,end:long,label:string>>"
)


def scan(text: bytes) -> tuple:
    """One document: counts, places of base phrases, labels, score and byte spans."""
    lowered = text.lower()  # of bytes: A-Z alone
    inside = _WORD[np.frombuffer(lowered, np.uint8)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    places, base = [], set()
    if b"license" in lowered:
        for label, pattern in _base_patterns():
            met = [m.start() for m in pattern.finditer(lowered)]
            if met:
                base.add(label)
                places += np.searchsorted(np.flatnonzero(starts), met).tolist()  # words that start before each
    kept = detect(lowered)
    miss = 1.0
    for weight in [d.weight for d in kept] + [0.5] * bool(base):
        miss *= 1 - weight
    return (
        int(np.count_nonzero(starts)), len(places),
        min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | {d.label for d in kept})),
        1 - miss if kept or base else 0.0,
        [{"start": d.start, "end": d.end, "label": d.label} for d in kept],
    )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License labels of every document, with the byte spans of the detections.

    A null or empty text has no words, empty labels and score 0; null ids and
    repeated rows are scanned like any other; further columns are left out. One
    pass, no shuffle; a task holds one Arrow batch.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text")
    )
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
        ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(text.as_py() or b"") for text in batch.column(1)]
            columns = list(zip(*found)) if found else [[] for _ in range(len(schema) - 1)]
            arrays = [pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)

    return rows.mapInArrow(run, COLUMNS)
