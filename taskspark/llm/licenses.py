"""License notices by ordered signature rules.

A rule is a regex with a keyword that a text must contain before the regex is tried, a priority and a label.
Of overlapping detections, one that lies inside another of higher priority, or inside a longer one of the
same priority, is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import LOWER, WordHasher, flat, kept_by_worker, runs, slices

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Phrases that always count, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Without one of these no rule can match, whatever its keyword.
HINTS = ("licen", "spdx", "under", "rights", "domain")
#: label | keywords (every match holds one; without blanks, as a name may go over a line break) | public identifier | how the name is written
LICENSES = r"""
mit | mit | mit | (?:the )?mit
mit-0 | mit | mit-0 | mit[- ]0|mit no attribution
x11 | x11 | x11 | x11|mit/x11
apache-1 | apache | apache-1\.[01] | apache(?: software)?(?: licen[cs]e)?,? (?:version |v)?1(?:\.[01])?
apache-2 | apache/al2/asl | apache-2\.0 | apache(?: software)?(?: licen[cs]e)?,? (?:version |v\.? ?)?2(?:\.0)?|al2|asl 2(?:\.0)?
bsd-0 | bsd | 0bsd | (?:zero[- ]clause|0[- ]clause) bsd|0bsd
bsd-2 | bsd | bsd-2-clause | (?:2|two)[- ]clause bsd|(?:simplified|freebsd) bsd|bsd[- ](?:2|two)[- ]clause
bsd-3 | bsd | bsd-3-clause | (?:3|three)[- ]clause bsd|(?:new|modified|revised) bsd|bsd[- ](?:3|three)[- ]clause
bsd-4 | bsd | bsd-4-clause | (?:4|four)[- ]clause bsd|(?:original|old) bsd|bsd[- ](?:4|four)[- ]clause
bsd | bsd | bsd | bsd(?:[- ]style)?
gpl-1 | gnu/gpl | gpl-1\.0(?:-only|-or-later)?\+? | gnu (?:general public licen[cs]e|gpl),? (?:version |v)1(?:\.0)?|gpl(?:[- ]?v?1)(?:\.0)?
gpl-2 | gnu/gpl | gpl-2\.0(?:-only|-or-later)?\+? | gnu (?:general public licen[cs]e|gpl),? (?:version |v)2(?:\.0)?|gpl(?:[- ]?v?2)(?:\.0)?
gpl-3 | gnu/gpl | gpl-3\.0(?:-only|-or-later)?\+? | gnu (?:general public licen[cs]e|gpl),? (?:version |v)3(?:\.0)?|gpl(?:[- ]?v?3)(?:\.0)?
gpl | gnu/gpl | gpl | gnu general public licen[cs]e|gnu gpl|gpl
lgpl-2 | gnu/gpl | lgpl-2\.0(?:-only|-or-later)?\+? | gnu (?:library|lesser) general public licen[cs]e,? (?:version |v)2(?:\.0)?|lgpl(?:[- ]?v?2)(?:\.0)?
lgpl-2.1 | gnu/gpl | lgpl-2\.1(?:-only|-or-later)?\+? | gnu lesser general public licen[cs]e,? (?:version |v)2\.1|lgpl(?:[- ]?v?2\.1)
lgpl-3 | gnu/gpl | lgpl-3\.0(?:-only|-or-later)?\+? | gnu lesser general public licen[cs]e,? (?:version |v)3(?:\.0)?|lgpl(?:[- ]?v?3)(?:\.0)?
lgpl | gnu/gpl | lgpl | gnu lesser general public licen[cs]e|gnu lgpl|lgpl
agpl-3 | gnu/gpl | agpl-3\.0(?:-only|-or-later)?\+? | gnu affero general public licen[cs]e,? (?:version |v)3(?:\.0)?|agpl(?:[- ]?v?3)(?:\.0)?
agpl | gnu/gpl | agpl | gnu affero general public licen[cs]e|affero gpl|agpl
gfdl | gfdl/documentation | gfdl-1\.[123](?:-only|-or-later)? | gnu free documentation licen[cs]e(?:,? (?:version |v)1\.[123])?|gfdl
mpl-1 | mozilla/mpl | mpl-1\.[01] | mozilla public licen[cs]e,? (?:version |v)?1\.[01]
mpl-2 | mozilla/mpl | mpl-2\.0 | mozilla public licen[cs]e,? (?:version |v)?2(?:\.0)?|mpl[- ]?(?:v ?)?2(?:\.0)?
mpl | mozilla/mpl | mpl | mozilla public licen[cs]e
epl-1 | eclipse/epl | epl-1\.0 | eclipse public licen[cs]e,?(?: -)? (?:version |v)?1(?:\.0)?|epl[- ]?1(?:\.0)?
epl-2 | eclipse/epl | epl-2\.0 | eclipse public licen[cs]e,?(?: -)? (?:version |v)?2(?:\.0)?|epl[- ]?2(?:\.0)?
edl | edl/eclipse | edl-1\.0 | eclipse distribution licen[cs]e(?: v?1\.0)?
cddl-1 | cddl/development | cddl-1\.[01] | common development and distribution licen[cs]e(?:,? (?:version |v)?1\.[01])?|cddl(?:[- ]1\.[01])?
cpl | cpl/common | cpl-1\.0 | common public licen[cs]e(?:,? (?:version |v)?1\.0)?
cpal | cpal/common | cpal-1\.0 | common public attribution licen[cs]e(?:,? (?:version |v)?1\.0)?
eupl-1.1 | european/eupl | eupl-1\.1 | european union public licen[cs]e,? (?:version |v)?\.? ?1\.1|eupl[- ]?v?1\.1
eupl-1.2 | european/eupl | eupl-1\.2 | european union public licen[cs]e,? (?:version |v)?\.? ?1\.2|eupl[- ]?v?1\.2
cc0 | cc/creative | cc0-1\.0 | cc0(?: 1\.0)?(?: universal)?|creative commons zero
cc-by-nc-nd | cc/creative | cc-by-nc-nd-[1-4]\.[05] | cc[- ]by[- ]nc[- ]nd(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non-?commercial[- ]no ?derivat(?:ive)?s?(?:works)?(?: [1-4]\.[05])?
cc-by-nc-sa | cc/creative | cc-by-nc-sa-[1-4]\.[05] | cc[- ]by[- ]nc[- ]sa(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non-?commercial[- ]share ?alike(?: [1-4]\.[05])?
cc-by-nc | cc/creative | cc-by-nc-[1-4]\.[05] | cc[- ]by[- ]nc(?:[- ][1-4]\.[05])?|creative commons attribution[- ]non-?commercial(?: [1-4]\.[05])?
cc-by-nd | cc/creative | cc-by-nd-[1-4]\.[05] | cc[- ]by[- ]nd(?:[- ][1-4]\.[05])?|creative commons attribution[- ]no ?deriv(?:ative)?s?(?: [1-4]\.[05])?
cc-by-sa | cc/creative | cc-by-sa-[1-4]\.[05] | cc[- ]by[- ]sa(?:[- ][1-4]\.[05])?|creative commons attribution[- ]share ?alike(?: [1-4]\.[05])?
cc-by | cc/creative | cc-by-[1-4]\.[05] | cc[- ]by(?:[- ][1-4]\.[05])?|creative commons attribution(?: [1-4]\.[05])?
public-domain | public/cc-pddc | cc-pddc | public domain(?: dedication)?
unlicense | unlicen | unlicense | unlicense
wtfpl | wtfpl/fuck | wtfpl | wtfpl|do what the fuck you want to public licen[cs]e
isc | isc | isc | isc
zlib | zlib | zlib | zlib(?:/libpng)?
libpng | libpng | libpng(?:-2\.0)? | libpng
boost | boost/bsl | bsl-1\.0 | boost software licen[cs]e(?:,?(?: -)? version 1\.0)?|boost
busl | business/busl | busl-1\.1 | business source licen[cs]e(?:,? (?:version |v)?1\.1)?
sspl | server/sspl | sspl-1\.0 | server side public licen[cs]e(?:,? (?:version |v)?1)?|sspl
elastic | elastic | elastic-2\.0 | elastic licen[cs]e(?:,? (?:version |v)?2(?:\.0)?)?
artistic-1 | artistic | artistic-1\.0(?:-perl)? | artistic licen[cs]e(?:,? (?:version |v)?1(?:\.0)?)
artistic-2 | artistic | artistic-2\.0 | artistic licen[cs]e(?:,? (?:version |v)?2(?:\.0)?)
artistic | artistic | clartistic | artistic
perl | perl | perl | same terms as perl(?: itself)?
python | python/psf | (?:python-2\.0|psf-2\.0) | python software foundation|psf
ruby | ruby | ruby | ruby
php | php | php-3\.0?1? | php(?: licen[cs]e,? (?:version |v)?3\.01)?
openssl | openssl | openssl | openssl
ofl | open/ofl | ofl-1\.[01] | (?:sil )?open font licen[cs]e(?:,? (?:version |v)?1\.[01])?
odbl | open/odbl | odbl-1\.0 | open (?:data commons )?database licen[cs]e|odbl
odc-by | open/odc | odc-by-1\.0 | open data commons attribution licen[cs]e
pddl | open/pddl | pddl-1\.0 | open data commons public domain dedication
afl | academic/afl | afl-[123]\.[01] | academic free licen[cs]e(?:,? (?:version |v)?[123]\.[01])?
osl | open/osl | osl-[123]\.[01] | open software licen[cs]e(?:,? (?:version |v)?[123]\.[01])?
ms-pl | microsoft/ms-pl | ms-pl | microsoft public licen[cs]e
ms-rl | microsoft/ms-rl | ms-rl | microsoft reciprocal licen[cs]e
upl | universal/upl | upl-1\.0 | universal permissive licen[cs]e(?:,? (?:version |v)?1\.0)?
ncsa | ncsa | ncsa | (?:university of illinois/)?ncsa(?: open source)?
postgresql | postgresql | postgresql | postgresql
vim | vim | vim | vim
beerware | beer | beerware | beer-?ware
json | json | json | json
curl | curl | curl | curl
w3c | w3c | w3c(?:-20150513)? | w3c(?: software)?
mulan | mulan | mulanpsl-[12]\.0 | mulan (?:permissive software|psl)(?: licen[cs]e)?,? v?[12]
openrail | rail | openrail(?:-m|\+\+)? | (?:creativeml |bigscience )?(?:open)?rail(?:[- ]m|\+\+)?
llama | llama | llama-?[234](?:\.[0-9])? | llama ?[234](?:\.[0-9])?(?: community)?
gemma | gemma | gemma | gemma
proprietary | rights/proprietary | licenseref-proprietary | all rights reserved
"""  # noqa: E501

#: How a notice frames a name: pattern around it, priority, score. Every license has a rule per frame.
FRAMES = (
    (r"spdx-license-identifier:\s*(?:{id})(?![\w.-])", 90, 1.0),
    (
        r"\b(?:licen[cs]ed|released|distributed|available|published|provided|covered|dedicated|redistributed)\s+"
        r"(?:to\s+(?:you|the)\s+)?under\s+(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+)?"
        r"(?:{name})(?![\w-])(?:\s+licen[cs]e)?", 70, 0.95,
    ),
    (r"\b(?:{name})(?![\w-])[\s,-]+(?:public\s+|software\s+|open\s+source\s+)?licen[cs]e\b", 50, 0.8),
    (r"\blicen[cs]e\s*[:=]\s*[\"']?(?:{name}|{id})(?![\w.-])", 60, 0.9),
)


#: Notices that stand alone: label, keyword, pattern, priority, score.
ALONE = (
    ("proprietary", "rights", r"\ball\s+rights\s+reserved\b", 30, 0.5),
    ("public-domain", "domain", r"\b(?:in|into|to)\s+the\s+public\s+domain\b", 30, 0.7),
)


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    score: float


def signatures() -> list[Signature]:
    """One rule per license and frame and for each notice that stands alone, most important first."""
    rules = [Signature(label, word, re.compile(pattern), *rest) for label, word, pattern, *rest in ALONE]
    for line in LICENSES.strip().splitlines():
        label, keyword, identifier, name = line.split(" | ", 3)
        for frame, priority, score in FRAMES:
            spelt = name.replace("[- ]", r"[-\s]").replace(" ?", r"\s*").replace(" ", r"\s+")
            pattern = frame.replace("{id}", identifier).replace("{name}", spelt)
            rules.append(Signature(label, keyword, re.compile(pattern), priority, score))
    return sorted(rules, key=lambda r: -r.priority)


def detections(text: str, rules: list[Signature]) -> list[tuple[int, int, Signature]]:
    """(start, end, rule) in a lower-cased text, contained ones suppressed."""
    if not any(hint in text for hint in HINTS):
        return []
    found = []
    opened: dict[str, bool] = {}
    for rule in rules:
        if rule.keyword not in opened:
            opened[rule.keyword] = any(word in text for word in rule.keyword.split("/"))
        if opened[rule.keyword]:
            found += [(*m.span(), rule) for m in rule.pattern.finditer(text)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    return sorted(outermost(found), key=lambda d: d[:2])


def outermost(found: list[tuple[int, int, Signature]]) -> Iterator[tuple[int, int, Signature]]:
    """Those of ``found`` (start, end, ..) that no earlier one contains.

    The furthest end among the starts up to a place is kept in a tree of prefix maxima, so each of n detections
    costs log n steps.
    """
    starts = sorted({d[0] for d in found})
    ends = [-1] * (len(starts) + 1)
    for one in found:
        place = bisect_right(starts, one[0])
        at, furthest = place, -1
        while at:
            furthest = max(furthest, ends[at])
            at &= at - 1
        if furthest >= one[1]:
            continue
        yield one
        while place <= len(starts):
            ends[place] = max(ends[place], one[1])
            place += place & -place


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    ``spans`` are the detections of the rules (label, start, end) in code points. Null reads as empty: no
    words, no labels, score 0. Repeated rows stay repeated; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = kept_by_worker("license rules", signatures)
        hasher = WordHasher()
        wanted = []
        for phrase, label in PHRASES:
            data, offsets = flat(pa.array([phrase]))
            starts, ends, _ = runs(WORD[data], offsets)
            wanted.append((hasher(data, starts, ends), label))
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            data, offsets = flat(texts)
            data = LOWER[data]
            starts, ends, bounds = runs(WORD[data], offsets)
            words = hasher(data, starts, ends)
            rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
            places: list[list[tuple[int, str]]] = [[] for _ in range(len(texts))]
            for phrase, label in wanted:
                n = len(phrase)
                hit = np.ones(max(len(words) - n + 1, 0), bool)
                for k in range(n):
                    hit &= words[k : k + len(hit)] == phrase[k]
                hit &= rows[: len(hit)] == rows[n - 1 : n - 1 + len(hit)]
                for at in np.flatnonzero(hit):
                    places[rows[at]].append((int(at - bounds[rows[at]]), label))
            out = []
            for k in range(len(texts)):
                text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
                found = detections(text, rules)
                base = {label for _, label in places[k]}
                spots = [at for at, _ in places[k]]
                both = base | {rule.label for *_, rule in found}
                score = max([1.0] * bool(base) + [rule.score for *_, rule in found], default=0.0)
                out.append(
                    {
                        "n_words": int(bounds[k + 1] - bounds[k]), "n_base": len(spots),
                        "first_word": min(spots, default=None), "last_word": max(spots, default=None),
                        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(both)), "score": score,
                        "spans": [{"label": r.label, "start": a, "end": b} for a, b, r in found],
                    }
                )
            done = pa.RecordBatch.from_pylist(out, schema=arrow)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *done.columns], names=["doc_id", *arrow.names])

    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    arrow = pa.schema(
        [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", span)]
    )
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, spans array<struct<label: string, start: bigint, end: bigint>>"
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
