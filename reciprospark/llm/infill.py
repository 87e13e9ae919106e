"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, joined in another order between sentinels.

One Aho-Corasick automaton finds the ASCII characters at which the class of a text changes and the sentinels. These events are
sparse: the gaps between them hold a number of units that follows from their length alone (none, one, or one for each
code point), so the running count over events and gaps is all that a rank lookup needs (where do the first k units end?).

Units: "line" (`[^\\n]*\\n|[^\\n]+`), "run" (white space, or what lies between) or "character" (a code point). The cuts and the form
come from the sha256 of the seed and the id, so a row's result depends on nothing else. A text that is empty or holds a
sentinel stays as it is (plain), so whatever has another form can be taken apart again without loss.

Cases: a null text is an empty one; a null id is hashed as empty text; repeated rows are each transformed; texts of any length
are scanned whole; an empty table gives an empty one. Columns of docs named like an added one are replaced, others stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import record, slices, table

SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 7, 100, 50
#: The characters at which a class changes, by unit.
CHANGES = {"line": "\n", "run": " \t\n\x0b\x0c\r", "character": ""}
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


class Scanner:
    """Events of texts: one automaton for the class-changing characters and the sentinels."""

    def __init__(self, unit: str = "line", sentinels: tuple[str, str, str] = SENTINELS):
        if unit not in CHANGES:
            raise ValueError(f"unit {unit!r} is none of {', '.join(CHANGES)}")
        if len({*sentinels}) != 3 or not all(sentinels):
            raise ValueError("three different sentinels are needed, none of them empty")
        if any(a != b and a in b or any(b.startswith(a[k:]) for k in range(1, len(a))) for a in sentinels for b in sentinels):
            raise ValueError("no sentinel may lie within another one, or end as one begins")
        self.unit, self.automaton = unit, ahocorasick.Automaton()
        for c in CHANGES[unit]:
            self.automaton.add_word(c, -1)
        for s in sentinels:
            self.automaton.add_word(s, len(s))
        self.automaton.make_automaton()

    def events(self, text: str) -> tuple[np.ndarray, bool]:
        """Code points of the class-changing characters, and whether the text holds a sentinel."""
        found = list(self.automaton.iter(text))
        at = np.array([k for k, kind in found if kind < 0], dtype=np.int64)
        return at, len(at) < len(found)


class Ranks:
    """Where the first k units of a text end, from its events alone."""

    def __init__(self, unit: str, at: np.ndarray, length: int):
        gaps = np.diff(np.concatenate([[-1], at, [length]])) - 1
        self.ends = np.empty(2 * len(at) + 1, dtype=np.int64)  # of a gap, an event, a gap, ...
        self.ends[0::2], self.ends[1::2] = np.append(at, length), at + 1
        units = np.zeros_like(self.ends)  # that end in each of them
        if unit == "line":
            units[1::2] = 1
            units[-1] = gaps[-1] > 0
        elif unit == "run":
            units[0::2] = gaps > 0
            units[1::2] = (gaps[1:] > 0) | (np.arange(len(at)) == len(at) - 1)
        else:
            units[0::2], units[1::2] = gaps, 1
        self.upto = np.cumsum(units)
        self.count = int(self.upto[-1])

    def end(self, k: int) -> int:
        if k == 0:
            return 0
        here = int(np.searchsorted(self.upto, k))
        return int(self.ends[here] - (self.upto[here] - k))  # a gap of many units has one for each code point


def draws(seed: int, key: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def cut(scanner: Scanner, text: str, numbers: list[int], rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None]:
    """Units of a text, its form, and the code points of prefix and middle. numbers: four of them decide."""
    at, marked = scanner.events(text)
    ranks = Ranks(scanner.unit, at, len(text))
    if not text or marked or numbers[2] % 100 >= rate:
        return ranks.count, "plain", None, None
    a, b = sorted(x % (ranks.count + 1) for x in numbers[:2])
    first, second = ranks.end(a), ranks.end(b)
    return ranks.count, "spm" if numbers[3] % 100 < spm else "psm", first, second - first


def transformed(docs: DataFrame, unit: str = "line", key: str = "doc_id", rate: int = RATE, spm: int = SPM, seed: int = SEED, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """docs with n (units), form (plain, psm, spm), prefix_chars, middle_chars (code points; null if plain) and output.

    rate: of a hundred texts, how many are cut; spm: of a hundred of these, how many have the suffix first. sentinels: of prefix, suffix and middle.
    """
    Scanner(unit, sentinels)
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ADDED])
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["n long", "form string", "prefix_chars long", "middle_chars long", "output binary"])
    more = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, (p, s, m) = Scanner(unit, sentinels), sentinels
        for batch, texts in slices(batches):
            out = []
            for id_, raw in zip(batch.column(batch.schema.get_field_index(key)).to_pylist(), texts, strict=True):
                text = raw.decode("utf-8", "surrogateescape")
                n, form, before, middle = cut(scanner, text, draws(seed, id_), rate, spm)
                if form != "plain":
                    first, second, third = text[:before], text[before : before + middle], text[before + middle :]
                    text = "".join([p, first, s, third, m, second] if form == "psm" else [s, third, p, first, m, second])
                out.append((n, form, before, middle, text.encode("utf-8", "surrogateescape")))
            yield record(pa.schema([*batch.schema, *[pa.field(*x) for x in more]]), [*batch.columns, *[[x[k] for x in out] for k in range(len(more))]])

    return docs.mapInArrow(run, fields).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output and its form were made of."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_infill(spark, sf_dir: str) -> DataFrame:
    found = transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as x from documents),
h as (select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u, ('0x' || x[1:8])::bigint as h1, ('0x' || x[9:16])::bigint as h2, ('0x' || x[17:24])::bigint as h3, ('0x' || x[25:32])::bigint as h4 from d),
c as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from h),
p as (select *, coalesce(array_to_string(u[1 : a], ''), '') as p, coalesce(array_to_string(u[a + 1 : b], ''), '') as m, coalesce(array_to_string(u[b + 1 :], ''), '') as s from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars, case when form <> 'plain' then length(m) end::bigint as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from p
"""
