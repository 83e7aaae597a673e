"""Surrogates for personal data (operator 4).

Mentions of persons, e-mail addresses, phone numbers, IPv4 addresses, card and account numbers, social security
numbers and secrets are replaced by keyed surrogates of the same type and format: digits stay digits, hexadecimal
stays hexadecimal, a valid card checksum stays valid, a given name gets another of its gender, a surname one of its
script, and the case of every letter is kept. The same entity gets the same surrogate everywhere (coreference), also
across formats: entities are compared in a canonical form, and the surrogate is written in the format of the mention.

Distinctness is checked over the corpus: the distinct entities form a table; where two draw one surrogate, or a
surrogate is itself an entity of the corpus, all but the first draw again with the next attempt, until none collide.
Only entities that had to draw again differ from the keyed first draw; those few go back to the texts, by broadcast
while they are few and by a join on the mentions of each text beyond that.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.storage import arrow_map, saved
from webloom.llm.words import free_name

#: Redrawn entities that may be broadcast; more are joined.
BROADCAST_ROWS = 50_000
MAX_ATTEMPTS = 64
#: Attempts in a closed format; each further run of as many widens it, so that a free surrogate is left.
CLOSED_ATTEMPTS = 8

# Given names by script and gender; a given name is replaced by another of its list.
GIVEN = {
    "latin-f": ("Anna", "Maria", "Laura", "Julia", "Sophie", "Emma", "Clara", "Elena", "Lucia", "Carmen", "Marie", "Claire",
                "Mary", "Jennifer", "Susan", "Linda", "Sarah", "Emily", "Katharina", "Ursula", "Isabelle", "Pilar"),
    "latin-m": ("Peter", "Michael", "Thomas", "Daniel", "Martin", "Carlos", "Miguel", "Pedro", "Javier", "Pierre", "Jacques",
                "John", "James", "Robert", "David", "William", "Hans", "Klaus", "Stefan", "Antoine", "Louis", "Pablo"),
    "cyrillic-f": ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Светлана", "Ирина"),
    "cyrillic-m": ("Иван", "Дмитрий", "Сергей", "Алексей", "Михаил", "Николай", "Андрей", "Владимир"),
    "greek-f": ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Δήμητρα"),
    "greek-m": ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας", "Παύλος", "Πέτρος"),
}
# Forms of address by gender; the word after one is a surname.
TITLES = {"f": ("Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "Sra"), "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr")}
# Syllables that surnames are made of, by script.
SYLLABLES = {
    "latin": ("ba", "ber", "cor", "da", "del", "fen", "gar", "hol", "ka", "lin", "lo", "mar", "mon", "ner", "or", "pel", "ri", "ros", "sa", "sen", "ta", "ter", "vel", "win"),
    "cyrillic": ("ба", "вер", "гор", "да", "дел", "жен", "за", "ко", "лин", "ло", "мар", "мен", "нов", "ор", "пе", "ри", "рос", "са", "та", "тин", "хол", "шев"),
    "greek": ("βα", "γα", "δη", "ζα", "θε", "κα", "λα", "μα", "νι", "πα", "ρο", "σα", "τα", "φο", "χρη", "πουλ"),
}
_NAME_OF = {n: kind for kind, names in GIVEN.items() for n in names}
_CAP = "[A-ZÀ-ÖØ-ÞА-ЯΆ-Ϋ][a-zß-öø-ÿа-яά-ώ]+"
_SURNAME = rf"{_CAP}(?:-{_CAP})?"

# One pattern for each type, in order of precedence; group "v" is the entity where it is not the whole.
PATTERNS = {
    "secret": re.compile(r"""(?i)(?<![^\W_])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)["']?\s*[=:]\s*["']?(?P<v>[A-Za-z0-9_\-+/=]{12,})"""
                         r"""|(?<![A-Za-z0-9])(?P<w>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,})(?![A-Za-z0-9])"""),
    "email": re.compile(r"(?<![\w.+-])[\w+-](?:[\w.+-]{0,62}[\w+-])?@[^\W_](?:[\w-]{0,62})(?:\.[^\W_](?:[\w-]{0,62}))*\.[^\W\d_]{2,24}(?![\w-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ipv4": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)"),
    "card": re.compile(r"(?<![\w+-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)\d{3,4}[ .-]?\d{3,4}(?![\w-])"
                        r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w-])|(?<![\w+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"),
    "person": re.compile(rf"(?<!\w)(?P<title>{'|'.join(t for k in TITLES.values() for t in k)})\.? (?P<only>{_SURNAME})(?!\w)"
                         rf"|(?<!\w)(?P<given>{'|'.join(sorted(_NAME_OF, key=len, reverse=True))}) (?P<sur>{_SURNAME})(?!\w)"),
}
_DIGIT = re.compile(r"\d")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def script(word: str) -> str:
    return "cyrillic" if re.match("[А-яЁё]", word) else "greek" if re.match("[Ά-ώ]", word) else "latin"


def canonical(kind: str, mention: str) -> str:
    """The form in which mentions of one entity are equal."""
    if kind in ("phone", "card", "ssn"):
        return "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "")
    return mention if kind in ("secret", "ipv4") or kind.startswith("given") else mention.lower()


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of each entity, left to right; where two overlap the earlier pattern wins."""
    found: list[tuple[int, int, str]] = []
    digits = _DIGIT.search(text) is not None
    for kind, pattern in PATTERNS.items():
        if kind in ("iban", "ipv4", "card", "ssn", "phone") and not digits or kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if kind == "person":
                parts = [(*m.span(g), "surname-" + script(m[g])) for g in ("only", "sur") if m[g]]
                parts += [(*m.span("given"), "given-" + _NAME_OF[m["given"]])] if m["given"] else []
            elif kind == "secret":
                parts = [(*m.span("v" if m["v"] else "w"), kind)]
            else:
                parts = [(*m.span(), kind)]
            for p in parts:  # spans so far are apart and in order: only the neighbours can overlap
                at = bisect.bisect_left(found, p)
                if not (at and found[at - 1][1] > p[0] or at < len(found) and found[at][0] < p[1]):
                    found.insert(at, p)
    return [(s, e, k, canonical(k, text[s:e])) for s, e, k in found]


class Draw:
    """Numbers below given bounds from an HMAC of (kind, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.block, self.pool = key, f"{kind}\0{value}\0{attempt}".encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.bits < 64:
            self.pool = int.from_bytes(hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest(), "big")
            self.block, self.bits = self.block + 1, 256
        got, self.pool, self.bits = self.pool % (1 << 64) % n, self.pool >> 64, self.bits - 64
        return got

    def like(self, c: str) -> str:
        """A character of the class of ``c``; other characters stay."""
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            low = chr(97 + self.below(26))
            return low.upper() if c.isupper() else low
        return c


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value. Type, length of digits, script and gender are kept.

    From CLOSED_ATTEMPTS on e-mail names, secrets and phone numbers get longer and octets take any number of digits.
    """
    draw = Draw(key, kind, value, attempt)
    wider = attempt // CLOSED_ATTEMPTS
    if kind.startswith("given-"):
        # all names of a list move along by one keyed step, so no two meet and none stays
        names = GIVEN[kind[6:]]
        step = 1 + Draw(key, kind, "", 0).below(len(names) - 1)
        return names[(names.index(value) + step) % len(names)]
    if kind.startswith("surname-"):
        return "-".join("".join(SYLLABLES[kind[8:]][draw.below(len(SYLLABLES[kind[8:]]))] for _ in range(3 + draw.below(2) + attempt // 8))
                        for _ in value.split("-"))
    if kind == "email":
        local, _, domain = value.rpartition("@")
        names = domain.split(".")
        of_domain = Draw(key, "domain", domain, 0)  # addresses of one domain stay together
        host = ".".join(["".join(of_domain.like(c) for c in label) for label in names[:-1]] + names[-1:])
        return "".join(draw.like(c) for c in local + "a" * wider) + "@" + host
    if kind == "ipv4" and wider:
        return ".".join(str(draw.below(256)) for _ in range(4))
    if kind == "ipv4":
        return ".".join(str(1 + draw.below(9) if len(o) == 1 else 10 + draw.below(90) if len(o) == 2 else 100 + draw.below(156)) for o in value.split("."))
    if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
        made = "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(value) + wider))
        return made.upper() if value.upper() == value else made
    if kind == "iban":
        return value[:2] + "".join(draw.like(c) for c in value[2:])
    made = "".join(draw.like(c) for c in value + ("a" if kind == "secret" else "0" if kind == "phone" else "") * wider)
    if kind == "phone" and len(made) > 10:
        made = value[:max(0, len(value) - 10)] + made[max(0, len(value) - 10):]  # the country stays
    if kind == "card" and luhn(value):
        made = next(made[:-1] + c for c in "0123456789" if luhn(made[:-1] + c))
    return made


def written(kind: str, mention: str, made: str) -> str:
    """A canonical surrogate in the format of a mention: its separators and the case of its letters."""
    if kind in ("phone", "card", "ssn"):
        rest = iter(made)
        return "".join(next(rest) if c.isdigit() else c for c in mention) + "".join(rest)
    if kind == "iban":
        rest = iter(made)
        return "".join(c if c == " " else next(rest) for c in mention)
    if kind.startswith("surname-"):
        return made.upper() if mention.isupper() else "-".join(p.capitalize() for p in made.split("-"))
    if kind == "email":
        return made.upper() if mention.isupper() else made
    return made


def replace(text: str, key: bytes, redrawn: dict[tuple[str, str], str]) -> tuple[str, int]:
    """The text with every mention replaced, and the number of mentions."""
    found, out, at = mentions(text), [], 0
    for s, e, kind, value in found:
        made = redrawn.get((kind, value)) or surrogate(key, kind, value)
        out += [text[at:s], written(kind, text[s:e], made)]
        at = e
    return ("".join(out) + text[at:]) if found else text, len(found)


def entities(docs: DataFrame, text_col: str) -> DataFrame:
    """Distinct (kind, value) of all whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {(k, v) for t in batch.column(0) for _, _, k, v in mentions(t.as_py() or "")}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([v for _, v in got], pa.string())], names=["kind", "value"])

    return arrow_map(docs.select(F.col(text_col).cast("string")), run, "kind string, value string").distinct()


def assign(found: DataFrame, key: str) -> DataFrame:
    """(kind, value, made, attempt) for each distinct entity: no two of a kind share ``made``, and no ``made`` is an
    entity of its kind. Given names are a keyed rotation of closed lists and need no check."""
    secret = key.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, v, a = (batch.column(c).to_pylist() for c in range(3))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(secret, *x) for x in zip(k, v, a, strict=True)], pa.string())],
                                             names=["kind", "value", "attempt", "made"])

    def drawn(rows: DataFrame) -> DataFrame:
        return arrow_map(rows.select("kind", "value", "attempt"), run, "kind string, value string, attempt int, made string")

    closed = F.col("kind").startswith("given-")
    settled, waiting = None, found.withColumn("attempt", F.lit(0))
    for _ in range(MAX_ATTEMPTS):
        rows = drawn(waiting)
        taken = found.select("kind", F.col("value").alias("made"), F.lit(1).alias("hit"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "made", F.lit(1).alias("hit")))
        first = F.row_number().over(Window.partitionBy("kind", "made").orderBy("value"))
        rows = saved(rows.withColumn("nth", first).join(taken.distinct(), ["kind", "made"], "left")
                     .withColumn("ok", closed | ((F.col("nth") == 1) & F.col("hit").isNull())))
        good = rows.filter("ok").select("kind", "value", "made", "attempt")
        settled = good if settled is None else settled.unionByName(good)
        bad = rows.filter(~F.col("ok"))
        if bad.isEmpty():
            return settled
        waiting = bad.select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
    raise ValueError(f"entities still collide after {MAX_ATTEMPTS} attempts")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every mention in the text replaced; all other columns as they were.

    ``key`` is the secret of the surrogates: the same key gives the same surrogates in every run over one corpus.
    ``count_col``: name of an added column with the number of mentions (underscores before it where ``docs`` has it). A null text stays null and counts 0; a text
    without mentions is unchanged; repeated rows stay repeated and equal; an empty table stays empty.
    """
    found = saved(entities(docs, text_col))
    redrawn = saved(assign(found, key).filter("attempt > 0").select("kind", "value", "made"))
    at, secret = docs.columns.index(text_col), key.encode()
    schema = T.StructType([T.StructField(f.name, T.StringType()) if k == at else f for k, f in enumerate(docs.schema)]
                          + ([T.StructField(free_name(docs.columns, count_col), T.LongType())] if count_col else []))
    n_out = len(docs.columns)
    if redrawn.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = docs
        shared = docs.sparkSession.sparkContext.broadcast({(r.kind, r.value): r.made for r in redrawn.collect()})
    else:
        rows, shared = _with_redrawn(docs, redrawn, text_col), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(n_out).to_pylist() if shared is None else None
            texts, counts = [], []
            for k, t in enumerate(batch.column(at)):
                t = t.as_py()
                known = shared.value if own is None else {(a, b): c for a, b, c in own[k] or ()}
                made, n = (None, 0) if t is None else replace(t, secret, known)
                texts.append(made)
                counts.append(n)
            columns = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns[:n_out])]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(counts, pa.int64())] if count_col else []), names=schema.names)

    return arrow_map(rows, run, schema)


def _with_redrawn(docs: DataFrame, redrawn: DataFrame, text_col: str) -> DataFrame:
    """``docs`` and, in a last column, the redrawn entities of each text as [kind, value, made] lists.

    The join key is two hashes of the text: equal texts have equal mentions, so rows need no identity of their own.
    """
    key = [F.xxhash64(F.col(text_col)).alias("_h"), F.hash(F.col(text_col)).alias("_g")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(h, g, k, v) for h, g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                   for k, v in {(k, v) for _, _, k, v in mentions(t or "")}]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in got], (pa.int64(), pa.int32(), pa.string(), pa.string())[c]) for c in range(4)],
                                             names=["_h", "_g", "kind", "value"])

    each = arrow_map(docs.select(*key, F.col(text_col).cast("string")), run, "_h long, _g int, kind string, value string").distinct()
    lists = each.join(redrawn, ["kind", "value"]).groupBy("_h", "_g").agg(F.collect_list(F.array("kind", "value", "made")).alias("_redrawn"))
    h, g = free_name(docs.columns, "_h"), free_name(docs.columns, "_g")
    last = free_name(docs.columns, "_redrawn")
    lists = lists.select(F.col("_h").alias("jh"), F.col("_g").alias("jg"), F.col("_redrawn").alias(last))
    rows = docs.withColumn(h, key[0]).withColumn(g, key[1])
    joined = rows.join(lists, (rows[h] == lists["jh"]) & (rows[g] == lists["jg"]), "left")
    return joined.select(*[rows[c] for c in docs.columns], joined[last])
