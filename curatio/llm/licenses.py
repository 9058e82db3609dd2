"""License scan by ordered signature rules.

Several hundred regex rules are built from a table of licenses and a few
sentence forms. A rule runs on a text only where all its keywords occur
(byte search), and overlapping detections are resolved by rule priority and
interval containment: a detection inside one of higher priority, or inside a
longer one of equal priority, is dropped. Texts are read whole, lower-cased in
A-Z, as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Pure per-row work: one ``mapInArrow``, no shuffle, memory bounded by the text
chunk. Defined results: null or empty text has no words, labels "" and score
0; nulls in the id are carried; repeated rows and ties give equal results; an
empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curatio.llm import textnum as tn
from curatio.operators.util import ship_by_value

#: Phrases that always count, with their labels (fixed values).
BASE = (("under the mit license", "mit"),
        ("apache license version 2", "apache-2"),
        ("cc by nc", "cc-by-nc"))

#: License table (fixed values): label, SPDX identifiers, names. A name may
#: hold "{v}", filled from the versions of its row.
LICENSES = (
    ("mit", ("mit", "mit-0", "x11"), ("mit", "expat", "x11"), ()),
    ("apache-{v}", ("apache-{v}.0",), ("apache", "apache software"), ("1", "2")),
    ("gpl-{v}", ("gpl-{v}.0", "gpl-{v}.0-only", "gpl-{v}.0-or-later"),
     ("gnu general public", "gnu gpl", "gpl"), ("1", "2", "3")),
    ("lgpl-{v}", ("lgpl-{v}", "lgpl-{v}-only", "lgpl-{v}-or-later"),
     ("gnu lesser general public", "gnu library general public", "gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0")),
    ("agpl-{v}", ("agpl-{v}.0", "agpl-{v}.0-only", "agpl-{v}.0-or-later"),
     ("gnu affero general public", "affero general public", "agpl"), ("1", "3")),
    ("gfdl-{v}", ("gfdl-{v}", "gfdl-{v}-only", "gfdl-{v}-or-later"),
     ("gnu free documentation", "gfdl"), ("1.1", "1.2", "1.3")),
    ("mpl-{v}", ("mpl-{v}",), ("mozilla public", "mpl"), ("1.0", "1.1", "2.0")),
    ("epl-{v}", ("epl-{v}",), ("eclipse public", "epl"), ("1.0", "2.0")),
    ("cddl-{v}", ("cddl-{v}",), ("common development and distribution", "cddl"), ("1.0", "1.1")),
    ("bsd-2-clause", ("bsd-2-clause",), ("bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"), ()),
    ("bsd-3-clause", ("bsd-3-clause",), ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd"), ()),
    ("bsd-4-clause", ("bsd-4-clause",), ("bsd 4 clause", "4 clause bsd", "original bsd"), ()),
    ("isc", ("isc",), ("isc", "internet systems consortium"), ()),
    ("zlib", ("zlib",), ("zlib", "zlib libpng"), ()),
    ("boost-1.0", ("bsl-1.0",), ("boost software", "boost"), ()),
    ("unlicense", ("unlicense",), ("unlicense",), ()),
    ("wtfpl", ("wtfpl",), ("do what the fuck you want to public", "wtfpl"), ()),
    ("artistic-{v}", ("artistic-{v}.0",), ("artistic", "perl artistic"), ("1", "2")),
    ("eupl-{v}", ("eupl-{v}",), ("european union public", "eupl"), ("1.1", "1.2")),
    ("python-2.0", ("psf-2.0", "python-2.0"), ("python software foundation", "psf"), ()),
    ("ofl-1.1", ("ofl-1.1",), ("sil open font", "open font"), ()),
    ("openssl", ("openssl",), ("openssl",), ()),
    ("php-3.01", ("php-3.01",), ("php",), ()),
    ("ruby", ("ruby",), ("ruby",), ()),
    ("postgresql", ("postgresql",), ("postgresql",), ()),
    ("odbl-1.0", ("odbl-1.0",), ("open database", "odbl"), ()),
    ("odc-by-1.0", ("odc-by-1.0",), ("open data commons attribution", "odc by"), ()),
    ("pddl-1.0", ("pddl-1.0",), ("public domain dedication and license", "pddl"), ()),
    ("cc0-1.0", ("cc0-1.0",), ("cc0", "creative commons zero", "creative commons public domain dedication"), ()),
    ("cc-by-{v}", ("cc-by-{v}",), ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa-{v}", ("cc-by-sa-{v}",),
     ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
     ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-{v}", ("cc-by-nc-{v}",),
     ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
     ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd-{v}", ("cc-by-nd-{v}",), ("cc by nd", "creative commons attribution noderivatives"),
     ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa-{v}", ("cc-by-nc-sa-{v}",),
     ("cc by nc sa", "creative commons attribution noncommercial sharealike"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd-{v}", ("cc-by-nc-nd-{v}",),
     ("cc by nc nd", "creative commons attribution noncommercial noderivatives"), ("2.0", "2.5", "3.0", "4.0")),
)

#: Rules of their own: label, regex over words, keywords, priority, weight.
EXTRA = (
    ("proprietary", "all rights reserved", ("rights", "reserved"), 2, 0.7),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", ("public", "domain"), 3, 0.9),
    ("public-domain", "(?:is|are) in the public domain", ("public", "domain"), 2, 0.7),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("permission", "granted"), 4, 1.0),
    ("bsd", "redistribution and use in source and binary forms with or without modification",
     ("redistribution", "binary"), 4, 1.0),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     ("permission", "distribute"), 4, 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors",
     ("provided", "warranty"), 4, 1.0),
    ("non-commercial", "(?:for )?non ?commercial (?:use|purposes?) only", ("commercial", "only"), 2, 0.6),
    ("copyright", "copyright (?:c |© )?(?:19|20)[0-9]{2}", ("copyright",), 1, 0.4),
    ("spdx", "spdx license identifier [0-9a-z]+", ("spdx",), 1, 0.5),
)

_WORD = tn.byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_SEP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_LEFT, _RIGHT = rb"(?<![0-9a-z\x80-\xff])", rb"(?![0-9a-z\x80-\xff])"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str              # over lower-case words joined by one space
    keywords: tuple[str, ...]
    priority: int             # the higher wins
    weight: float


def _words(s: str) -> str:
    return " ".join(w for w in re.split(r"[^0-9a-z]+", s) if w)


def signature_rules() -> list[Rule]:
    """All rules, highest priority first: for each license and version its
    SPDX identifier, the versioned name in three sentence forms, and the bare
    name followed by license or licence."""
    out = []
    for label, ids, names, versions in LICENSES:
        for v in versions or ("",):
            full = label.replace("{v}", v)
            for i in ids:
                w = _words(i.replace("{v}", v))
                out.append(Rule(full, f"spdx license identifier {w}", ("spdx", w.split()[0]), 6, 1.0))
            for name in names:
                key = max(name.split(), key=len)
                if v:
                    ver = _words(v)
                    tail = f"(?:license |licence )?(?:version |v |v)?{ver}(?: 0)?" if "." not in v else \
                        f"(?:license |licence )?(?:version |v |v)?{ver}"
                    out.append(Rule(full, f"{name} {tail}", (key, ver.split()[0]), 5, 0.9))
                    out.append(Rule(full, f"(?:licensed|released|distributed|available) under (?:the )?{name} {tail}",
                                    ("under", key), 6, 1.0))
                else:
                    out.append(Rule(full, f"(?:the )?{name} licen[cs]e", ("licen", key), 4, 0.8))
                    out.append(Rule(full, f"(?:licensed|released|distributed|available) under (?:the )?{name}",
                                    ("under", key), 5, 0.9))
        if versions:
            family = label.replace("-{v}", "")
            for name in names:
                key = max(name.split(), key=len)
                out.append(Rule(family, f"(?:the )?{name} licen[cs]e", ("licen", key), 3, 0.7))
                out.append(Rule(family, f"(?:licensed|released|distributed|available) under (?:the )?{name}",
                                ("under", key), 4, 0.8))
    out += [Rule(label, p, k, pr, w) for label, p, k, pr, w in EXTRA]
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern))


def resolve(found: list[tuple[int, int, int, int, str, float]]) -> list[tuple[int, int, int, int, str, float]]:
    """(start, end, priority, rule, label, weight) detections that survive:
    one contained in another of higher priority, or in a longer one of equal
    priority, or equal to an earlier rule's, is suppressed."""
    place = {s: k + 1 for k, s in enumerate(sorted({d[0] for d in found}))}
    reach = [0] * (len(place) + 1)      # a prefix maximum by start of the kept ends, in a binary indexed tree
    kept = []
    for d in sorted(found, key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
        k, most = place[d[0]], 0
        while k:
            most = max(most, reach[k])
            k -= k & -k
        if most >= d[1]:
            continue
        kept.append(d)
        k = place[d[0]]
        while k < len(reach):
            reach[k] = max(reach[k], d[1])
            k += k & -k
    return sorted(kept)


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.base = [(re.compile(_LEFT + _SEP.join(w.encode() for w in p.split()) + _RIGHT),
                      tuple(w.encode() for w in p.split()), label) for p, label in BASE]
        self.rules = []
        for n, r in enumerate(rules):
            # a space of the pattern stands for any run of separators
            p = r.pattern.encode("utf-8").replace(b" ", _SEP)
            self.rules.append((n, re.compile(_LEFT + b"(?:" + p + b")" + _RIGHT),
                               tuple(k.encode() for k in r.keywords), r))
        self.keywords = sorted({k for _, _, ks, _ in self.rules for k in ks})
        #: keywords that every rule has one of: nothing runs without them
        self.gate = [k for k in (b"licen", b"spdx", b"under", b"copyright", b"permission", b"reserved", b"domain",
                                 b"redistribution", b"provided", b"commercial")]
        self.versioned = sorted({k for _, _, ks, r in self.rules for k in ks
                                 if r.priority == 5 and not k.isdigit()})

    def scan(self, text: bytes, n_words: int):
        """(n_base, first, last, base labels, labels, score) of a lower-cased text."""
        starts, labels = [], set()
        for pattern, parts, label in self.base:
            if all(p in text for p in parts):
                hits = [m.start() for m in pattern.finditer(text)]
                if hits:
                    starts += hits
                    labels.add(label)
        found = []
        if any(k in text for k in self.gate) or any(k in text for k in self.versioned):
            have = {k for k in self.keywords if k in text}
            for n, pattern, keys, rule in self.rules:
                if all(k in have for k in keys):
                    found += [(m.start(), m.end(), rule.priority, n, rule.label, rule.weight)
                              for m in pattern.finditer(text)]
        kept = resolve(found)
        first = last = None
        if starts:
            row = np.frombuffer(text, np.uint8)
            at, _, _ = tn.runs(row, np.array([0, len(row)]), _WORD)
            first, last = (int(np.searchsorted(at, s)) for s in (min(starts), max(starts)))
        score = max([1.0] * bool(starts) + [d[5] for d in kept], default=0.0)
        every = labels | {d[4] for d in kept}
        return len(starts), first, last, ",".join(sorted(labels)), ",".join(sorted(every)), score


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row: words, base places and labels, all labels, score
    (the largest weight of a surviving detection)."""
    ship_by_value(__name__, "curatio.llm.textnum")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    rules = signature_rules() if rules is None else rules
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        scanner = Scanner(rules)
        for batch in batches:
            for part in tn.chunks(batch, "text"):
                buf, offsets = tn.as_bytes(part.column("text"))
                low = tn.lower_ascii(buf)
                _, _, row = tn.runs(low, offsets, _WORD)
                n_words = np.bincount(row, minlength=part.num_rows)
                raw = low.tobytes()
                rows = [scanner.scan(raw[a:b], n) for a, b, n in zip(offsets[:-1], offsets[1:], n_words)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n_words.astype(np.int64)), *(pa.array(c, pa.int64()) for c in cols[:3]),
                     *(pa.array(c, pa.string()) for c in cols[3:5]), pa.array(cols[5], pa.float64())],
                    [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, {SCHEMA}")
