"""Reading one spelling of a person's or institution's name."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

#: Titles before and letters after a person's name.
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "mx", "sir", "dame", "rev"}
SUFFIXES = {"phd", "msc", "bsc", "ma", "md", "dphil", "dsc", "esq", "jr", "sr", "ii", "iii", "iv"}
#: Particles that belong to a family name.
PARTICLES = {"de", "la", "van", "der", "den", "al", "von", "zu", "di", "da", "del", "el", "le", "du", "dos", "ibn", "bin", "ter", "ten", "of"}
#: Particles and runs of them that are written together with a family name.
GLUED = ("de", "la", "van", "der", "den", "al", "von", "di", "da", "del", "el", "le", "du", "dos", "ibn", "bin", "dela", "vander", "vanden", "vonder")
#: Kinds of institution with their short forms.
KINDS = {
    "centre": "centre center ctr cen cent", "institute": "institute inst instit", "university": "university univ uni u",
    "laboratory": "laboratory lab labs laboratories", "observatory": "observatory obs obsv obsy", "collaboration": "collaboration coll collab",
    "college": "college", "school": "school sch", "academy": "academy acad", "department": "department dept", "faculty": "faculty fac",
    "agency": "agency", "museum": "museum mus", "consortium": "consortium", "foundation": "foundation", "national": "national natl nat nat'l",
}
#: Words of institution names that carry nothing.
LINK_WORDS = {"for", "of", "the", "and", "in", "at", "&"}
#: Letters that do not decompose.
PLAIN = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ð": "d", "þ": "th", "ı": "i", "’": "'", "‘": "'", "‐": "-", "‑": "-", "–": "-"})

#: Of the rolling hashes; they only bring words together that are then compared.
_BASE, _PRIME = 0x1F3D5B79A2C4E, (1 << 61) - 1

KIND_OF = {form: kind for kind, forms in KINDS.items() for form in forms.split()}


def plain(s: str) -> str:
    """Without accents, ignorable characters and doubled blanks, in its own letter case."""
    s = unicodedata.normalize("NFKD", s.translate(PLAIN))
    return " ".join("".join(c for c in s if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").split())


def untransliterated(word: str) -> str:
    """``juergen`` and ``jurgen`` alike."""
    return re.sub(r"([aou])e", r"\1", word)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, lost, changed or swapped character at most lies between two words."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])


def _deletions(word: str) -> set[str]:
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def starts(word: str) -> list[int]:
    """A hash of each of the word's beginnings, shortest first, the whole word last."""
    h, out = 0, []
    for c in word:
        h = (h * _BASE + ord(c) + 1) % _PRIME
        out.append(h)
    return out


def left_out(word: str) -> list[int]:
    """Hashes of the word and of all that is left of it without one character; words one edit apart share one.

    They are rolled, so that a long word costs no more than its length.
    """
    before = [0, *starts(word)]
    out, after, power = {before[-1]}, 0, 1
    for i in range(len(word) - 1, -1, -1):
        out.add((before[i] * power + after) % _PRIME)
        after = ((ord(word[i]) + 1) * power + after) % _PRIME
        power = power * _BASE % _PRIME
    return list(out)


@dataclass
class Words:
    """Words with counts, and for each misspelt one the word it stands for.

    A word is taken as misspelt if one edit leads to a word ``odds`` times as
    frequent; ``sure`` words never are.
    """

    counts: dict[str, int]
    sure: frozenset[str] = frozenset()
    odds: int = 5
    known: dict[str, str] = field(default_factory=dict)
    near: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for w in [*self.counts, *self.sure]:
            for x in _deletions(w):
                self.near.setdefault(x, []).append(w)
        for w in [*self.counts, *self.sure]:
            self.known[w] = w if w in self.sure else self._best(w, self.counts.get(w, 0) * self.odds) or w

    def _best(self, w: str, least: int) -> str | None:
        if len(w) < 4:
            return None
        found = {x for y in _deletions(w) for x in self.near.get(y, ()) if x != w and len(x) > 3 and one_edit(w, x) and (self.counts.get(x, 0) >= max(1, least) or (x in self.sure and not least))}
        return max(found, key=lambda x: (self.counts.get(x, 0), x)) if found else None

    def correct(self, w: str) -> str | None:
        """The word that ``w`` is or is a misspelling of, if any."""
        if w in self.known:
            return self.known[w]
        return self._best(w, 0)

    def longer(self, w: str) -> str | None:
        """The commonest word that ``w`` begins, or shortens by an apostrophe."""
        if "'" in w:
            head, tail = w.split("'", 1)
            found = {x for x, y in self.known.items() if x == y and x.startswith(head) and x.endswith(tail)}
        else:
            found = {y for x, y in self.known.items() if len(x) > len(w) and x.startswith(w) and len(w) >= 3}
        return max(found, key=lambda x: (self.counts.get(x, 0), x)) if found else None


class Looked:
    """What Words tells of the words of one spelling, looked up beforehand."""

    def __init__(self, found) -> None:
        self.known = {x["token"]: x["stands"] for x in found if x["known"]}
        self._stands = {x["token"]: x["stands"] for x in found}
        self._longer = {x["token"]: x["longer"] for x in found}

    def correct(self, w: str) -> str | None:
        return self._stands.get(w)

    def longer(self, w: str) -> str | None:
        return self._longer.get(w)


@dataclass(frozen=True)
class Reading:
    """``place`` is a family name or a place; ``full`` the given name or what stands at the place; ``hint`` an abbreviation of it."""

    place: str
    full: str = ""
    hint: str = ""
    middle: str = ""


def _word(t: str) -> str:
    return t.strip(".,;").lower()


def _is_initials(t: str, shouted: bool) -> bool:
    w = t.rstrip(",")
    if re.fullmatch(r"(?:[^\W\d_]\.[- ]?)+[^\W\d_]?\.?", w):
        return True
    w = w.strip(".")
    return len(w) == 1 or (len(w) == 2 and (w.isupper() or w.islower()) and not shouted and w.lower() not in PARTICLES)


def comma_given(spelling: str) -> str | None:
    """The first given name of a ``Family, Given`` spelling, in lower case."""
    parts = [p.strip() for p in plain(spelling).split(",")]
    parts = [p for p in parts if p and _word(p).replace(".", "") not in SUFFIXES]
    if len(parts) != 2 or not parts[1].split():
        return None
    first = parts[1].split()[0]
    return None if "." in first or len(first) < 3 else _word(first)


def person_tokens(spelling: str) -> set[str]:
    """All words of a spelling that PersonReader may look up."""
    ws = {_word(t) for t in plain(spelling).replace(",", " ").split()}
    return {w for w in ws | {untransliterated(w) for w in ws} if w}


class PersonReader:
    """Reads ``Given M. Family``, ``Family, Given``, ``FAMILY Given``, ``GM Family`` and the like.

    ``given`` are the given names of the corpus, learned from spellings with a
    comma; they tell given from family names where order and case don't.
    """

    def __init__(self, given: Words) -> None:
        self.given = given

    def _given(self, w: str) -> str | None:
        got = self.given.correct(w)
        return got or self.given.correct(untransliterated(w)) if "e" in w else got

    def _split(self, ts: list[str]) -> tuple[list[str], list[str]]:
        low = [_word(t) for t in ts]
        is_given = [w in self.given.known for w in low]
        # In shouted text two letters are initials unless a given name stands beside them.
        shouted = all(t.isupper() for t in ts) and any(is_given)
        ini = [_is_initials(t, shouted) for t in ts]
        # ``AL Smith`` has initials, ``AL SMITH Ann`` a particle.
        loud = any(t.isupper() and len(_word(t)) > 2 for t in ts)
        ini = [i or (not loud and bool(re.fullmatch("[A-Z]{2}", t))) for i, t in zip(ini, ts)]
        is_given = [g and not i for g, i in zip(is_given, ini)]
        if not any(is_given) and not any(ini):
            is_given = [w not in PARTICLES and self._given(w) is not None for w in low]
        caps = [t.isupper() and len(_word(t)) > 1 and not i for t, i in zip(ts, ini)]
        if any(caps) and not all(c or i for c, i in zip(caps, ini)):
            k = 0
            if caps[0]:
                while caps[k]:
                    k += 1
                return ts[:k], ts[k:]
            k = len(ts)
            while caps[k - 1]:
                k -= 1
            if k < len(ts):
                while k > 1 and _word(ts[k - 1]) in PARTICLES:
                    k -= 1
                return ts[k:], ts[:k]
        first_family = (low[0] in PARTICLES and not ini[0]) or (not ini[0] and not is_given[0] and (any(is_given[1:]) or ini[-1]))
        if first_family and not (not any(is_given) and not ini[-1] and (low[0] not in PARTICLES or ini[0])):
            k = next((j for j in range(1, len(ts)) if is_given[j] or ini[j]), len(ts) - 1 if len(ts) > 1 else 1)
            return ts[:k], ts[k:]
        k = 1
        while k < len(ts) - 1 and (ini[k] or is_given[k]) and low[k] not in PARTICLES:
            k += 1
        return ts[k:], ts[:k]

    def read(self, spelling: str) -> Reading | None:
        """A single word is read as a whole; None where there is no word."""
        parts = [p.strip() for p in plain(spelling).split(",")]
        parts = [p for p in parts if p and _word(p).replace(".", "") not in SUFFIXES]
        cut = []
        for p in parts[:2]:
            ts = p.split()
            while ts and _word(ts[0]) in TITLES and not (re.fullmatch("[A-Z]{2}", ts[0]) and not p.isupper()):
                ts = ts[1:]
            while len(ts) > 1 and _word(ts[-1]).replace(".", "") in SUFFIXES:
                ts = ts[:-1]
            cut.append(ts)
        if len(cut) == 2:
            family, given = cut
        elif cut and len(cut[0]) > 1:
            family, given = self._split(cut[0])
        else:
            return whole(" ".join(cut[0])) if cut else None
        if not family or not given:
            return None
        name = untransliterated(re.sub(r"(?![ ])[\W\d_]", "", " ".join(map(_word, family)).replace("-", " ")))
        shouted = all(t.isupper() for t in family + given) and _word(given[0]) in self.given.known
        first, rest = given[0], [re.sub(r"[\W\d_]", "", _word(t)) for t in given[1:]]
        middle = rest[0][:1] if rest and rest[0] else ""
        if (_is_initials(first, shouted) or re.fullmatch("[A-Z]{2}", first)) and (_word(first) not in self.given.known or re.fullmatch("[A-Z]{2}", first)):
            letters = re.sub(r"[\W\d_]", "", first.lower())
            return Reading(name, hint=letters[:1], middle=letters[1:2] or middle) if letters and name else None
        return Reading(name, full=self._given(_word(first)) or _word(first), middle=middle) if name else None


def whole(spelling: str) -> Reading | None:
    """A spelling that can't be taken apart, which is like equal ones only."""
    w = " ".join(re.findall(r"[^\W_]+", spelling.lower()))
    return Reading(w, full=f"= {w}") if w else None


def initials(full: str) -> set[tuple[str, str]]:
    """(hint, middle) that may stand for a given name: its initial, and both initials of a double name."""
    return {(full[:1], "")} | ({(full[0], full.partition("-")[2][:1])} if "-" in full else set())


def core(place: str, particles: bool) -> str:
    """A family name (without its particles) or place, in one piece: ``van der Berg`` and ``Berg`` alike."""
    ws = place.split()
    return "".join(w for w in ws if w not in PARTICLES) or "".join(ws) if particles else "".join(ws)


_INSTITUTE_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


def comma_subject(spelling: str) -> list[str]:
    """The subject words of ``Kind for Subject, Place`` and ``Kind of Subject (Place)``, in lower case."""
    m = re.fullmatch(r"([^,()]+?)\s*(?:,\s*[^,()]+|\([^,()]+\))", plain(spelling).strip())
    ws = _INSTITUTE_WORD.findall(m[1].lower()) if m else []
    if len(ws) < 3 or ws[0] not in KIND_OF or ws[1] not in ("for", "of"):
        return []
    return [w for w in ws[2:] if w not in LINK_WORDS]


def institute_tokens(spelling: str) -> set[str]:
    """All words of a spelling that InstituteReader may look up."""
    return {w.lower() for w in _INSTITUTE_WORD.findall(plain(spelling))}


class InstituteReader:
    """Reads ``Kind for Subject, Place``, ``Place Kind``, ``Kind of Place``, ``ABC, Place`` and the like.

    ``subjects`` are the subject words of the corpus, learned from spellings that
    set the place apart; whatever is neither kind nor subject is the place.
    """

    def __init__(self, subjects: Words, acronyms: frozenset[str] = frozenset()) -> None:
        self.subjects, self.acronyms = subjects, acronyms | {"nl"}
        self.kinds = Words({}, frozenset(k for k in KIND_OF if len(k) > 3))

    def _subject(self, w: str, shortened: bool) -> str | None:
        if "'" in w:
            return self.subjects.longer(w)
        got = self.subjects.known.get(w)
        if got:
            if not shortened or got != w:
                return got
        if shortened or (not got and len(w) >= 3):
            found = self.subjects.longer(w)
            if found and (shortened or len(w) >= 4):
                return found
        return got or (self.subjects.correct(w) if len(w) > 4 else None)

    def read(self, spelling: str) -> Reading | None:
        s = plain(spelling)
        kinds, subject, place, acronym = [], [], [], ""
        apart = {w.lower() for m in re.findall(r",\s*([^,()]+)$|\(([^,()]+)\)", s) for x in m for w in _INSTITUTE_WORD.findall(x)}
        for m in _INSTITUTE_WORD.finditer(s):
            w, dot = m[0].lower(), s[m.end() : m.end() + 1] == "."
            if w in LINK_WORDS:
                continue
            if w.replace("'", "") in KIND_OF or w in KIND_OF:
                kinds.append(KIND_OF.get(w) or KIND_OF[w.replace("'", "")])
            elif (w in self.acronyms or (m[0].isupper() and 2 <= len(w) <= 5)) and not s.isupper():
                acronym = w
            elif w in self.acronyms:
                acronym = w
            elif (x := self._subject(w, dot)) and not (w in apart and x != w and not dot):
                subject.append(x)
            elif len(w) > 4 and (x := self.kinds.correct(w)) and w not in apart:
                kinds.append(KIND_OF[x])
            else:
                place.append(w)
        if len(place) > 1 and apart & set(place):
            place = [w for w in place if w in apart]
        name = untransliterated(" ".join(place))
        if not name:
            return whole(s)
        full = " ".join([*sorted(set(kinds)), "|", *sorted(set(subject))]) if kinds else ""
        if full:
            return Reading(name, full=full)
        return Reading(name, hint=acronym) if acronym else None

    def acronym(self, spelling: str) -> str:
        """The initials of kind and subject of a spelling that sets the place apart."""
        m = re.fullmatch(r"([^,()]+?)\s*(?:,\s*[^,()]+|\([^,()]+\))", plain(spelling).strip())
        ws = [w for w in _INSTITUTE_WORD.findall(m[1].lower()) if w not in LINK_WORDS] if m else []
        return "".join(w[0] for w in ws) if len(ws) > 1 else ""
