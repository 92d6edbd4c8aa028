"""Personal data and secrets replaced by surrogates.

Detected entities get keyed replacements of their own type: digits for
digits, letters for letters of the same script and case, valid check digits,
reserved mail domains, titles and first names of the same gender.  The
replacement depends only on the key, the type and the normal form of the
entity, so all mentions of one entity change alike.  Persons are resolved
within a text: a titled name gives its gender to all mentions of that person,
and later mentions of the full name or the surname without a title are linked.
Surnames and first names are drawn apart, so a shared surname stays shared in
all texts; a first name alone is no mention.  Two checks over the whole
corpus keep entities apart: no two get the same surrogate, and none gets
another entity's own value; losers draw again until none is left.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import map_batches, materialize

DEFAULT_KEY = b"surrogates"
MAX_DRAWS = 64

# Titles and first names by gender, for matching replacements.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
          "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Dr": "n", "Prof": "n"}
FIRST_NAMES = {
    "m": ["Adam", "Bruno", "Carlos", "David", "Erik", "Felix", "Georg", "Henri", "Ivan", "James", "Karl", "Louis",
          "Martin", "Noah", "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor"],
    "f": ["Alice", "Berta", "Clara", "Diana", "Emma", "Fiona", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura",
          "Maria", "Nina", "Olivia", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
}
GENDER_OF = {name: g for g, names in FIRST_NAMES.items() for name in names}

# One alternation, tried in this order at each place; the group that matched names the type.
PATTERNS = [
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----"),
    ("email", r"(?<![\w.+-])[A-Za-z0-9_][\w.+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"),
    ("aws_key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"),
    ("service_token", r"\b(?:ghp_|gho_|xox[bap]-|sk-)[A-Za-z0-9_-]{16,}"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|token|secret|api_?key|access_?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<secret_value>[^\s\"',;]{6,})"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    ("person", r"\b(?P<title>" + "|".join(TITLES) + r")\b\.? (?P<name>[A-ZÀ-ÖØ-Þ][\w'-]+(?: [A-ZÀ-ÖØ-Þ][\w'-]+)?)"),
]
FINDER = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS))
# What every match of a pattern contains: numbers two digits, at most one sign apart; the others a fixed part.
WORTH_LOOKING = re.compile(r"\d[ .-]?\d|@|[=:]|PRIVATE KEY|AKIA|ASIA|ghp_|gho_|xox[bap]-|sk-|\b(?:" + "|".join(TITLES) + r")\b")


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of the entities of a whole text.  Equal
    normal forms are one entity, however they are written."""
    if not WORTH_LOOKING.search(text):
        return []
    found, titled = [], []
    for m in FINDER.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("secret_value", "title", "name") else None
        kind = kind or next(k for k, _ in PATTERNS if m.group(k) is not None)
        start, end = m.span({"secret": "secret_value", "person": "name"}.get(kind, 0))
        value = text[start:end]
        if kind == "person":
            end -= 2 if value.endswith("'s") else 0
            titled.append((start, end, TITLES[m.group("title")], text[start:end]))
            continue
        if kind == "card" and not luhn_ok("".join(c for c in value if c.isdigit())):
            kind = "number"
        found.append((start, end, kind, normal_form(kind, value)))
    return sorted(found + persons(text, titled, found)) if titled else found


def persons(text: str, titled: list[tuple[int, int, str, str]], others: list[tuple]) -> list[tuple[int, int, str, str]]:
    """The mentions of the persons of a text, given its titled ones (start,
    end, gender of the title, name): full names as gender:first surname, with
    one gender for each person, and surnames alone as n:surname."""
    genders: dict[str, str] = {}              # of each full name, in the order of the text
    first_at: dict[str, int] = {}             # the first titled mention of each surname
    bearers: dict[str, list[str]] = {}        # full names of each surname
    for start, _, gender, name in titled:
        surname = name.rpartition(" ")[2]
        first_at.setdefault(surname, start)
        if " " in name:
            if name not in genders:
                bearers.setdefault(surname, []).append(name)
                genders[name] = "n"
            if genders[name] == "n":
                genders[name] = gender
    for name, gender in genders.items():
        if gender == "n":
            genders[name] = GENDER_OF.get(name.split(" ")[0], "n")
    for _, _, gender, name in titled:         # a surname with a title tells the gender of its only bearer
        own = bearers.get(name, ())
        if gender != "n" and len(own) == 1 and genders[own[0]] == "n":
            genders[own[0]] = gender

    def mention(start: int, end: int, name: str) -> tuple[int, int, str, str]:
        return start, end, "person", f"{genders.get(name, 'n')}:{name}"

    out = [mention(start, end, name) for start, end, _, name in titled]
    taken = sorted([(a, b) for a, b, *_ in out] + [(a, b) for a, b, *_ in others])
    starts = [a for a, _ in taken]
    for surname, from_on in first_at.items():
        at = text.find(surname)
        while at >= 0:
            start, end = at, at + len(surname)
            at = text.find(surname, end)
            full = next((n for n in bearers.get(surname, ()) if text.endswith(n, 0, end) and _whole(text, end - len(n), end)), None)
            if full:
                start = end - len(full)
            elif start < from_on or not _whole(text, start, end):
                continue
            i = bisect_right(starts, end - 1)
            if not i or taken[i - 1][1] <= start:
                out.append(mention(start, end, full or surname))
    # A surname may be a word of another person's name: of mentions that overlap the first and longest counts.
    kept: list[tuple[int, int, str, str]] = []
    for m in sorted(out, key=lambda m: (m[0], -m[1])):
        if not kept or m[0] >= kept[-1][1]:
            kept.append(m)
    return kept


def _whole(text: str, start: int, end: int) -> bool:
    """Whether the span is no part of a longer word."""
    before, after = text[start - 1:start], text[end:end + 1]
    return not (before.isalnum() or before in ("_", "-", "'", "@")) and not (after.isalnum() or after in ("_", "-", "@"))


def normal_form(kind: str, value: str) -> str:
    if kind == "email":
        return value.lower()
    if kind in ("card", "number", "phone", "ssn"):
        return "".join(c for c in value if c.isdigit())
    if kind == "iban":
        return value.replace(" ", "")
    return value


def drawn_parts(kind: str, form: str) -> list[tuple[str, str]]:
    """(kind, form) of what is drawn for an entity: itself, but for a person
    the surname and, if known, the first name among those with this surname."""
    if kind != "person":
        return [(kind, form)]
    surname = form[2:].rpartition(" ")[2]
    return [("surname", surname), *([("first_name", form)] if " " in form else [])]


class Draws:
    """A keyed stream of numbers for one entity and draw."""

    def __init__(self, key: bytes, kind: str, form: str, draw: int):
        self.seed = hmac.new(key, f"{kind}\x1f{form}\x1f{draw}".encode(), hashlib.sha256).digest()
        self.block, self.n = b"", 0

    def below(self, n: int) -> int:
        if len(self.block) < 8:
            self.block += hashlib.sha256(self.seed + self.n.to_bytes(8, "big")).digest()
            self.n += 1
        value, self.block = int.from_bytes(self.block[:8], "big"), self.block[8:]
        return value % n


def _alphabet(c: str) -> str | None:
    """The letters or digits that may replace ``c``: same script, same case."""
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    if "A" <= c <= "Z":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for low, high in ((0x3B1, 0x3C9), (0x391, 0x3A9), (0x430, 0x44F), (0x410, 0x42F), (0x5D0, 0x5EA), (0x4E00, 0x9FA5)):
        if low <= ord(c) <= high:
            return "".join(chr(x) for x in range(low, high + 1) if chr(x).isalpha())
    if "\u00c0" <= c <= "\u024f" and c.isalpha():      # Latin letters with marks
        return "àáâäèéêëìíîïòóôöùúûü" if c.islower() else "ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ"
    return _neighbours(c) if c.isalpha() else None


@lru_cache(maxsize=10_000)
def _neighbours(c: str) -> str:
    """The letters around ``c`` of its script and case: a letter's name begins with its script."""
    same = lambda x: (unicodedata.category(x), unicodedata.name(x, "").split(" ")[0])
    start = ord(c) & ~31
    return "".join(x for x in map(chr, range(start, start + 32)) if same(x) == same(c))


def _reshape(form: str, draws: Draws, hexadecimal: bool = False) -> str:
    out = []
    for c in form:
        letters = ("0123456789abcdef" if c.islower() or c.isdigit() else "0123456789ABCDEF") if hexadecimal \
            and c in "0123456789abcdefABCDEF" else _alphabet(c)
        out.append(letters[draws.below(len(letters))] if letters else c)
    return "".join(out)


def surrogate(kind: str, form: str, key: bytes = DEFAULT_KEY, draw: int = 0) -> str:
    """The replacement of a normal form, itself in normal form.  Later draws of
    short forms are longer, so that no type runs out of surrogates."""
    draws = Draws(key, kind, form, draw)
    longer = draw // 8
    if kind == "email":
        local, _, domain = form.partition("@")
        return f"{_reshape(local + 'a' * longer, draws)}@{_reshape(domain.split('.')[0], draws)}.example.com"
    if kind == "ip":
        first = "10" if not longer else str(1 + draws.below(223))
        return ".".join([first, *(str(draws.below(256)) for _ in range(3))])
    if kind == "phone":          # the country code stays; the rest keeps its length
        keep = len(form) - 9 if len(form) > 10 else 0
        return form[:max(0, keep - 1)] + _reshape(form[max(0, keep - 1):] + "0" * longer, draws)
    if kind == "card":
        body = form[0] + _reshape(form[1:-1] + "0" * longer, draws)
        return next(body + d for d in "0123456789" if luhn_ok(body + d))
    if kind == "iban":
        body = _reshape(form[4:] + "0" * longer, draws)
        number = int("".join(str(int(c, 36)) for c in body + form[:2] + "00"))
        return f"{form[:2]}{98 - number % 97:02d}{body}"
    if kind == "aws_key":
        return form[:4] + _reshape(form[4:] + "A" * longer, draws)
    if kind == "service_token":
        at = max(form.find("_"), form.find("-")) + 1 if not form.startswith("sk-") else 3
        return form[:at] + _reshape(form[at:] + "a" * longer, draws)
    if kind == "secret":
        if not any(map(_alphabet, form)):       # a masked one has no letter or digit to replace
            form = "a" * len(form)
        form += "a" * longer
        return _reshape(form, draws, hexadecimal=bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", form)))
    if kind == "private_key":
        head, _, rest = form.partition("KEY-----")
        body, _, tail = rest.rpartition("-----END")
        return f"{head}KEY-----{_reshape(body + 'a' * longer, draws)}-----END{tail}"
    if kind == "first_name":     # with the real surname: first names have to differ only within one
        first, _, surname = form[2:].partition(" ")
        if not first[0].isascii():
            return f"{_reshape(first + first[-1] * longer, draws)} {surname}"
        names = FIRST_NAMES[form[0]] if form[0] in FIRST_NAMES else sorted(GENDER_OF)
        return "-".join(names[draws.below(len(names))] for _ in range(1 + draw // 8)) + f" {surname}"
    if kind == "surname":
        return _reshape(form + "a" * longer, draws)
    return _reshape(form + "0" * longer, draws)


def written_like(kind: str, original: str, replaced: str) -> str:
    """The surrogate in the way that this mention was written: same spaces,
    signs and brackets; for mail addresses the same case."""
    if kind in ("card", "number", "phone", "ssn"):
        digits = iter(replaced)
        return "".join([next(digits) if c.isdigit() else c for c in original] + list(digits))
    if kind == "iban":
        letters = iter(replaced)
        return "".join([c if c == " " else next(letters) for c in original] + list(letters))
    if kind == "email" and original.isupper():
        return replaced.upper()
    return replaced


def replacement(kind: str, form: str, original: str, key: bytes, redraws: dict[tuple[str, str], int]) -> str:
    """What a mention becomes."""
    made = [surrogate(k, f, key, n) if (n := redraws.get((k, f), 0)) else first_draw(k, f, key)
            for k, f in drawn_parts(kind, form)]
    if kind == "person":
        return " ".join([*(m.rpartition(" ")[0] for m in made[1:]), made[0]])
    return written_like(kind, original, made[0])


@lru_cache(maxsize=100_000)
def first_draw(kind: str, form: str, key: bytes) -> str:
    return surrogate(kind, form, key, 0)


def redrawn(docs: DataFrame, key: bytes = DEFAULT_KEY, text_col: str = "text") -> DataFrame:
    """(kind, form, draw): entities that need another draw than the first,
    so that all surrogates differ from each other and from every entity of
    the same type.  Of several that drew the same one the first by form keeps it."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = sorted({part for t in batch.column(0).to_pylist() for _, _, k, f in detect(t) for part in drawn_parts(k, f)})
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.string()),
                                           pa.array([f for _, f in own], pa.string())], names=["kind", "form"])

    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    entities = materialize(map_batches(texts, find, "kind string, form string").distinct(), "pii-entities")

    def draw(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, forms, draws = (batch.column(i).to_pylist() for i in range(3))
        made = [surrogate(k, f, key, n) for k, f, n in zip(kinds, forms, draws)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                          names=["kind", "form", "draw", "made"])

    schema = "kind string, form string, draw int, made string"
    state = map_batches(entities.withColumn("draw", F.lit(0)), draw, schema)
    for _ in range(MAX_DRAWS):
        state = materialize(state, "pii-draws")
        # Losers: all but one of those with the same surrogate, and those that hit a real entity.
        clash = state.groupBy("kind", "made").agg(F.min_by("form", F.struct(F.col("draw") == 0, "form")).alias("f"),
                                                  F.count(F.lit(1)).alias("n")).where("n > 1")
        # The earliest holder keeps it: one that was settled before, else the first by form.
        clash = state.join(clash.select("kind", "made"), ["kind", "made"]) \
                     .groupBy("kind", "made").agg(F.min(F.struct("draw", "form")).alias("keeps"))
        shared = state.join(clash, ["kind", "made"]).where(F.struct("draw", "form") != F.col("keeps")) \
                      .select("kind", "form")
        real = state.join(entities.select("kind", F.col("form").alias("made")), ["kind", "made"], "left_semi") \
                    .select("kind", "form")
        lost = materialize(shared.union(real).distinct().withColumn("lost", F.lit(True)), "pii-lost")
        if not lost.take(1):
            return state.where("draw > 0").select("kind", "form", "draw")
        again = state.join(lost, ["kind", "form"], "left")
        state = again.where("lost is null").select("kind", "form", "draw", "made").union(
            map_batches(again.where("lost").select("kind", "form", (F.col("draw") + 1).alias("draw")), draw, schema))
    raise RuntimeError("surrogates keep clashing: a type has more entities than surrogates")


def replace(docs: DataFrame, key: bytes = DEFAULT_KEY, text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """``docs`` with every entity of every whole text replaced.

    ``with_spans`` adds ``n_entities`` and ``entities`` (type, place in the
    original, place in the result).  A null text stays null, an empty one
    empty.  Rows are neither merged nor dropped; null ids, repeated rows and
    extra columns pass through (columns of the added names are overwritten).
    """
    extra = materialize(redrawn(docs, key, text_col), "pii-redrawn")
    names = [c for c in docs.columns if not (with_spans and c in ("n_entities", "entities"))]
    base = docs.select(*names)
    if extra.take(1):
        # Only texts with redrawn entities need the table: their draws come by a join on the text's sum.
        def mention(batch: pa.RecordBatch) -> pa.RecordBatch:
            sums, kinds, forms = [], [], []
            for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, f in {part for _, _, k, f in detect(t) for part in drawn_parts(k, f)}:
                    sums.append(s)
                    kinds.append(k)
                    forms.append(f)
            return pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array(kinds, pa.string()),
                                               pa.array(forms, pa.string())], names=["_sum", "kind", "form"])

        texts = base.select(F.sha2(text_col, 256).alias("_sum"), F.col(text_col).alias("_t")).where("_t is not null")
        needed = (map_batches(texts, mention, "_sum string, kind string, form string").distinct()
                  .join(extra, ["kind", "form"]).groupBy("_sum")
                  .agg(F.sort_array(F.collect_list(F.struct("kind", "form", "draw"))).alias("_draws")))
        needed = materialize(needed, "pii-needed")
        base = base.withColumn("_sum", F.sha2(text_col, 256)).join(needed, "_sum", "left").drop("_sum")
    else:
        base = base.withColumn("_draws", F.lit(None).cast("array<struct<kind:string,form:string,draw:int>>"))
    at = names.index(text_col)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema]
    spans = "array<struct<kind:string,start:int,stop:int,new_start:int,new_stop:int>>"
    schema = ", ".join([*fields, *([f"n_entities int, entities {spans}"] if with_spans else [])])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, places = [], [], []
        for text, redraws in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
            own = []
            if text is not None:
                other = {(d["kind"], d["form"]): d["draw"] for d in redraws or ()}
                out, done, length = [], 0, 0
                for start, end, kind, form in detect(text):
                    new = replacement(kind, form, text[start:end], key, other)
                    out += [text[done:start], new]
                    length += start - done
                    own.append({"kind": kind, "start": start, "stop": end, "new_start": length,
                                "new_stop": length + len(new)})
                    length += len(new)
                    done = end
                text = "".join([*out, text[done:]]) if own else text
            texts.append(text)
            counts.append(len(own))
            places.append(own)
        cols = list(batch.columns[:len(names)])
        cols[at] = pa.array(texts, cols[at].type)
        if with_spans:
            item = pa.struct([("kind", pa.string()), *((n, pa.int32()) for n in ("start", "stop", "new_start", "new_stop"))])
            cols += [pa.array(counts, pa.int32()), pa.array(places, pa.list_(item))]
        return pa.RecordBatch.from_arrays(cols, names=[*names, *(["n_entities", "entities"] if with_spans else [])])

    return map_batches(base.select(*names, "_draws"), run, schema)
