"""License scan by ordered signature rules.

A rule is a regular expression over a text's words (lower-cased in A-Z, joined by one space), with the
label it gives, keywords of which the text must hold one, and a priority.
Two kinds make the table. ``notices.NOTICES`` are signature sentences of texts, notices and headers, written license by
license. ``LICENSES`` are hand-written name patterns and short names, each put into the ``FORMS`` in which any license
is named: declaration, grant, link, title and field.

1. An Aho-Corasick automaton over all keywords reads each lower-cased text once. Most texts end here.
2. Only the rules whose keywords were met are run, over the whole text.
3. Detections are ordered by priority, then length, then place. One that lies
   within a detection kept before it is suppressed, so that ``gnu lesser general public license`` is not
   also found as a general public license.

The *base* phrases are matched as consecutive words apart from the rules and never suppressed.
The score is the largest rule confidence among the kept detections, raised to ``BASE_SCORE`` by a base
phrase; 0 without any.

NULL is an empty text: no words, no labels, score 0. Texts are read whole; columns besides the id and the text are not read. Rows that repeat an id are scanned each. The time for
a text is linear in its length for each rule that is run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .notices import NOTICES
from .words import PLAIN, chunks, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: fixed values: base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_SCORE = 0.8

_VERSION = r"(?: (?:version|v))? ?"

#: label, name pattern over words, short-name patterns, keywords of which one must be in the text
LICENSES = (
    ("0bsd", r"(?:bsd )?zero clause(?: bsd)? licen[cs]e|free public licen[cs]e(?: 1 0 0)?", "0bsd", ("zero", "free public", "0bsd")),
    ("afl", r"academic free license", r"afl(?: [123] [01])?", ("academic", "afl")),
    ("agpl", r"(?:gnu )?affero general public license", r"agpl ?(?:v?[13](?: 0)?)?", ("affero", "agpl")),
    ("apache", r"apache(?: software)? licen[cs]e", r"apache(?: license)? 1 [01]", ("apache",)),
    ("apache 2.0", r"apache(?: software)? licen[cs]e" + _VERSION + r"2(?: 0)?", r"apache 2(?: 0)?|asl 2(?: 0)?", ("apache", "asl")),
    ("apsl", r"apple public source license", r"apsl(?: [12] [0-2])?", ("apple", "apsl")),
    ("artistic", r"(?:perl )?artistic license", r"artistic (?:1 0|2 0)", ("artistic",)),
    ("beerware", r"beer ?ware license", r"beer ?ware", ("beer",)),
    ("blue oak", r"blue oak model license", r"blueoak 1 0 0", ("blue oak", "blueoak")),
    ("boost", r"boost software license", r"bsl 1 0", ("boost", "bsl")),
    ("bsd", r"(?:new |modified |simplified |revised |original |berkeley )?bsd(?: style)? licen[cs]e", r"bsd", ("bsd",)),
    ("bsd 2-clause", r"(?:bsd (?:2|two) clause|simplified bsd|freebsd)(?: licen[cs]e)?", r"bsd 2 clause", ("bsd",)),
    ("bsd 3-clause", r"(?:bsd (?:3|three) clause|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", r"bsd 3 clause", ("bsd",)),
    ("bsd 4-clause", r"(?:bsd (?:4|four) clause|original bsd)(?: licen[cs]e)?", r"bsd 4 clause", ("bsd",)),
    ("busl", r"business source licen[cs]e", r"busl 1 1", ("business source", "busl")),
    ("cc0", r"creative commons zero|cc0(?: 1 0)?(?: universal)?", r"cc0(?: 1 0)?", ("creative", "cc0")),
    ("cc by", r"creative commons attribution(?: [1-4] [05])?(?: international| generic| unported)?", r"cc by(?: [1-4] [05])?", ("creative", "cc")),
    ("cc by-sa", r"creative commons attribution share ?alike", r"cc by sa(?: [1-4] [05])?", ("creative", "cc")),
    ("cc by-nc", r"creative commons attribution non ?commercial", r"cc by nc(?: [1-4] [05])?", ("creative", "cc")),
    ("cc by-nd", r"creative commons attribution no ?deriv(?:s|atives|ative works)", r"cc by nd(?: [1-4] [05])?", ("creative", "cc")),
    ("cc by-nc-sa", r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa(?: [1-4] [05])?", ("creative", "cc")),
    ("cc by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:s|atives)", r"cc by nc nd(?: [1-4] [05])?", ("creative", "cc")),
    ("cddl", r"common development and distribution license", r"cddl(?: 1 [01])?", ("common development", "cddl")),
    ("cecill", r"cecill(?: free software)? license(?: agreement)?", r"cecill(?: [bc12])?", ("cecill",)),
    ("cpl", r"common public license", r"cpl 1 0", ("common public", "cpl")),
    ("curl", r"curl license", r"curl", ("curl",)),
    ("ecl", r"educational community license", r"ecl [12] 0", ("educational", "ecl")),
    ("epl", r"eclipse public licen[cs]e", r"epl(?: [12] 0)?", ("eclipse", "epl")),
    ("eupl", r"european union public licen[cs]e", r"eupl(?: 1 [0-2])?", ("european", "eupl")),
    ("gfdl", r"(?:gnu )?free documentation license", r"gfdl(?: 1 [1-3])?", ("documentation", "gfdl")),
    ("gpl", r"(?:gnu )?general public licen[cs]e", r"(?:gnu )?gpl", ("general public", "gpl")),
    ("gpl 2.0", r"(?:gnu )?general public licen[cs]e" + _VERSION + r"2(?: 0)?", r"gpl ?v?2(?: 0)?(?: only| or later)?", ("general public", "gpl")),
    ("gpl 3.0", r"(?:gnu )?general public licen[cs]e" + _VERSION + r"3(?: 0)?", r"gpl ?v?3(?: 0)?(?: only| or later)?", ("general public", "gpl")),
    ("hpnd", r"historical permission notice and disclaimer", r"hpnd", ("historical", "hpnd")),
    ("intel", r"intel open source license", r"intel", ("intel",)),
    ("ipl", r"ibm public license", r"ipl 1 0", ("ibm", "ipl")),
    ("isc", r"isc licen[cs]e", r"isc", ("isc",)),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", r"(?:gnu )?lgpl", ("lesser", "library general", "lgpl")),
    ("lgpl 2.1", r"(?:gnu )?lesser general public licen[cs]e" + _VERSION + r"2 1", r"lgpl ?v?2 1(?: only| or later)?", ("lesser", "lgpl")),
    ("lgpl 3.0", r"(?:gnu )?lesser general public licen[cs]e" + _VERSION + r"3(?: 0)?", r"lgpl ?v?3(?: 0)?(?: only| or later)?", ("lesser", "lgpl")),
    ("lppl", r"latex project public license", r"lppl(?: 1 [0-3][abc]?)?", ("latex", "lppl")),
    ("mit", r"mit(?: x11| style)? licen[cs]e|expat license", r"mit|mit 0", ("mit", "expat")),
    ("mpl", r"mozilla public licen[cs]e", r"mpl(?: [12] [01])?", ("mozilla", "mpl")),
    ("ms-pl", r"microsoft public license", r"ms pl", ("microsoft", "ms")),
    ("ms-rl", r"microsoft reciprocal license", r"ms rl", ("microsoft", "ms")),
    ("mulan", r"mulan (?:permissive software|psl)(?: license)?", r"mulanpsl (?:1|2) 0", ("mulan",)),
    ("ncsa", r"(?:university of illinois )?ncsa open source license", r"ncsa", ("ncsa",)),
    ("odbl", r"open (?:data commons open )?database license", r"odbl(?: 1 0)?", ("database license", "odbl")),
    ("ofl", r"sil open font license", r"ofl(?: 1 [01])?", ("font license", "ofl")),
    ("openssl", r"openssl(?: and ssleay)? licen[cs]e", r"openssl", ("openssl",)),
    ("osl", r"open software license", r"osl(?: [123] [01])?", ("open software", "osl")),
    ("php", r"php license", r"php 3 0[1]?", ("php",)),
    ("postgresql", r"postgresql licen[cs]e", r"postgresql", ("postgresql",)),
    ("psf", r"python software foundation license", r"psf(?: 2 0)?|python 2 0(?: 1)?", ("python", "psf")),
    ("qpl", r"q public license", r"qpl(?: 1 0)?", ("q public", "qpl")),
    ("ruby", r"ruby license", r"ruby", ("ruby",)),
    ("sspl", r"server side public license", r"sspl(?: 1 0)?", ("server side", "sspl")),
    ("unicode", r"unicode(?: license agreement)? (?:data files and software|license)", r"unicode (?:dfs|3 0)", ("unicode",)),
    ("unlicense", r"the unlicense", r"unlicense", ("unlicense",)),
    ("upl", r"universal permissive license", r"upl 1 0", ("universal permissive", "upl")),
    ("vim", r"vim license", r"vim", ("vim",)),
    ("w3c", r"w3c software(?: notice and)?(?: and document)? license", r"w3c", ("w3c",)),
    ("wtfpl", r"do what the fuck you want to public license", r"wtfpl", ("do what the", "wtfpl")),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib", ("zlib",)),
    ("zpl", r"zope public license", r"zpl(?: [12] [01])?", ("zope", "zpl")),
)

#: form, priority, confidence, pattern; {name} and {short} are a license's own
FORMS = (
    ("declaration", 90, 1.0, r"spdx license identifier (?:{short})"),
    ("grant", 80, 0.95, r"(?:licensed|released|distributed|available|published|provided) (?:under|with) (?:the )?(?:terms of (?:the )?)?(?:{name}|(?:{short})(?: license)?)"),
    ("link", 70, 0.9, r"(?:opensource org licenses|spdx org licenses|choosealicense com licenses) (?:{short})"),
    ("title", 60, 0.85, r"(?:{name})"),
    ("field", 50, 0.8, r"licen[cs]e (?:is |type |name )?(?:the )?(?:{short})"),
)

@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    pattern: str
    keywords: tuple[str, ...]


def rules() -> list[Rule]:
    """The whole table, in order of priority."""
    made = [Rule(*notice) for notice in NOTICES]
    for label, name, short, keywords in LICENSES:
        made += [Rule(label, priority, confidence, form.format(name=name, short=short), keywords)
                 for _, priority, confidence, form in FORMS]
    return sorted(made, key=lambda r: -r.priority)


class Scanner:
    """Compiled rules behind one keyword automaton."""

    def __init__(self, table: list[Rule]):
        self.table = table
        self.patterns = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in table]
        self.automaton = ahocorasick.Automaton()
        by_keyword: dict[str, set[int]] = {}
        for i, rule in enumerate(table):
            for keyword in rule.keywords:
                by_keyword.setdefault(keyword, set()).add(i)
        for keyword, owners in by_keyword.items():
            # words of a phrase may be set apart by any signs: its longest word is looked for
            longest = max(keyword.split(), key=len)
            self.automaton.add_word(longest, set(owners) | self.automaton.get(longest, set()))
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """(start word, end word, rule), suppressed ones left out. ``text`` is lower-cased."""
        due = set().union(*(owners for _, owners in self.automaton.iter(text)))
        if not due:
            return []
        joined = " ".join(WORD.findall(text))
        found = [
            (m.start(), m.end(), i)
            for i in sorted(due) for m in self.patterns[i].finditer(joined) if m.end() > m.start()]
        if not found:
            return []
        gaps = np.flatnonzero(np.array([c == " " for c in joined]))
        found.sort(key=lambda d: (-self.table[d[2]].priority, d[0] - d[1], d[0]))
        kept: list[tuple[int, int, Rule]] = []
        places = {start: k for k, start in enumerate(sorted({d[0] for d in found}), 1)}
        furthest = [0] * (len(places) + 1)  # Fenwick tree: furthest end of the kept ones by start
        for start, end, i in found:
            k, reach = places[start], 0
            while k:
                k, reach = k & (k - 1), max(reach, furthest[k])
            if reach >= end:
                continue
            k = places[start]
            while k < len(furthest):
                furthest[k] = max(furthest[k], end)
                k += k & -k
            kept.append((int(np.searchsorted(gaps, start)), int(np.searchsorted(gaps, end - 1)) + 1, self.table[i]))
        return kept


@cache
def scanner() -> Scanner:
    return Scanner(rules())


_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE_WORDS = [(tuple(phrase.split()), label) for phrase, label in BASE.items()]


def base_places(text: str) -> list[tuple[int, str]]:
    """(start word, label) of every base phrase; ``text`` is lower-cased."""
    if "license" not in text:
        return []
    words = WORD.findall(text)
    return [
        (at - len(phrase) + 1, label)
        for at, word in enumerate(words) if word == "license"
        for phrase, label in _BASE_WORDS if at >= len(phrase) - 1 and tuple(words[at - len(phrase) + 1 : at + 1]) == phrase]


_FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start: long, end: long, label: string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = scanner()
    for batch in batches:
        sizes = np.concatenate([np.diff(words_of(data, bounds, PLAIN).first) for _, _, data, bounds in chunks(batch.column(1))] or [np.zeros(0, np.int64)])
        out = []
        for size, text in zip(sizes.tolist(), batch.column(1).to_pylist()):
            text = (text or "").translate(_LOWER) if text and not text.isascii() else (text or "").lower()
            base, found = base_places(text), scan.detections(text) if text else []
            at = [a for a, _ in base]
            base_labels = {label for _, label in base}
            score = max([BASE_SCORE] * bool(base) + [r.confidence for _, _, r in found], default=0.0)
            out.append((size, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)),
                        ",".join(sorted(base_labels | {r.label for _, _, r in found})), score,
                        [{"start": a, "end": b, "label": r.label} for a, b, r in found]))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))]
        columns = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base phrases, labels, score and the kept detections with their places."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_scan, f"doc_id long, {_FOUND}")
