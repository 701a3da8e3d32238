"""Personal information in free text: finding it, and replacing it by typed placeholders with keyed pseudonyms.

Texts are searched many at a time in one buffer.  Bitmaps of letters, digits, capitals and blanks and the hashes of
all words are made with numpy; they tell the few places where an address, a number, a street or a name can begin, and
only there a pattern is tried.  Finding is rule-based: e-mail addresses (also spelled out), phone numbers, identity
numbers, street addresses with a house number, and names.  A name is a given name (`given`, by default a list of common
Italian ones) next to a surname, an initial with a surname, or any two capitalised words that a title, a word like
"ricorrente" before them or words like "residente" behind them show to be a person.  Words of street names and
organisations are no names.

Replacement keeps formats: phone numbers, identity numbers and dates of birth are permuted by a keyed Feistel network
within their own format, so equal values stay linked across documents and the key turns them back.  Of a phone number
the national part counts; a tax code whose check letter is right gets another one whose check letter is right, in the
alphabets of its fields; a date gets another real date.  Other kinds get a keyed tag.

Defined results: null and blank texts hold nothing and stay as they are; repeated rows yield the same finds once in
`find`; finds never overlap (of two the one that starts first, then the longer one, stands); any length is treated whole.
"""

from __future__ import annotations

import base64
import datetime as dt
import functools
import hashlib
import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.functions.text import MONTHS
from lexgrain.operators.structure import span_hashes
from lexgrain.plans.scale import spread

KINDS = ("email", "phone", "id_number", "address", "name")
#: Characters of texts that are searched together.
TEXT_CHARS = 400_000

# Common Italian given names.
GIVEN = frozenset((
    "Ada", "Adele", "Adriana", "Adriano", "Agata", "Agnese", "Agostino", "Alba", "Alberico", "Alberto", "Aldo", "Alessandra", "Alessandro", "Alessia", "Alessio", "Alfredo", "Alice",
    "Amedeo", "Andrea", "Angela", "Angelo", "Anita", "Anna", "Antonella", "Antonia", "Antonio", "Armando", "Arturo", "Attilio", "Augusto", "Aurora", "Barbara", "Beatrice", "Benedetta",
    "Benito", "Bianca", "Bice", "Bruna", "Bruno", "Camilla", "Carla", "Carlo", "Carmela", "Carmelo", "Carmine", "Caterina", "Cecilia", "Cesare", "Chiara", "Cinzia", "Clara", "Claudia",
    "Claudio", "Clelia", "Concetta", "Corrado", "Cristian", "Cristina", "Daniela", "Daniele", "Dario", "Davide", "Debora", "Desirée", "Diego", "Domenico", "Donatella", "Donato", "Duilio",
    "Edoardo", "Egidio", "Elena", "Eleonora", "Elisa", "Elisabetta", "Emanuela", "Emanuele", "Emilia", "Emilio", "Emma", "Enrico", "Enzo", "Ernesto", "Ettore", "Eugenio", "Eva", "Ezio",
    "Fabio", "Fabrizio", "Federica", "Federico", "Felice", "Ferdinando", "Filippo", "Fiorenza", "Flavia", "Franca", "Francesca", "Francesco", "Franco", "Fulvio", "Gabriele", "Gaetano",
    "Gennaro", "Giacomo", "Giada", "Gianni", "Ginevra", "Gino", "Giorgia", "Giorgio", "Giovanna", "Giovanni", "Giulia", "Giulio", "Giuseppe", "Giuseppina", "Grazia", "Guido", "Ida",
    "Ilaria", "Irene", "Ivan", "Ivo", "Jacopo", "Laura", "Leonardo", "Lidia", "Linda", "Lorenzo", "Luca", "Lucia", "Luciano", "Luigi", "Luisa", "Maddalena", "Manuela", "Marcello", "Marco",
    "Margherita", "Maria", "Mariano", "Marina", "Mario", "Marta", "Martina", "Marzia", "Massimo", "Matteo", "Mattia", "Maurizio", "Mauro", "Michela", "Michele", "Mirella", "Monica",
    "Nadia", "Nicola", "Niccolò", "Nives", "Noemi", "Oreste", "Ornella", "Osvaldo", "Ottavio", "Paola", "Paolo", "Pasquale", "Patrizia", "Perla", "Piero", "Pietro", "Raffaele", "Renato",
    "Riccardo", "Rita", "Roberta", "Roberto", "Romano", "Rosa", "Rosalba", "Rosaria", "Salvatore", "Sandra", "Sante", "Sara", "Sebastiano", "Sergio", "Silvana", "Silvano", "Silvia",
    "Simona", "Simone", "Sofia", "Stefania", "Stefano", "Teodora", "Teresa", "Tiziana", "Tommaso", "Tullio", "Ugo", "Umberto", "Valentina", "Valeria", "Valerio", "Vera", "Veronica",
    "Vincenzo", "Virginia", "Vito", "Vittoria", "Vittorio", "Walter",
))
# Capitalised words that stand next to names without being part of them.
NO_NAME = frozenset((
    "a", "ad", "agli", "ai", "al", "all", "alla", "alle", "allo", "anche", "annex", "art", "article", "artikel", "articolo", "ausgenommen", "avv", "avvocato", "borgo", "canale", "cell",
    "che", "chi", "codice", "comune", "con", "considerato", "contatti", "contro", "copia", "corte", "da", "dal", "dall", "dalla", "dei", "del", "delega", "dell", "della", "delle", "der",
    "des", "dich", "die", "documento", "dott", "dottor", "dottoressa", "dr", "e", "ed", "ente", "entro", "fatti", "fattura", "fermo", "firmato", "fondazione", "gemäß", "gen", "geom", "gli",
    "i", "il", "in", "indirizzo", "ing", "istituto", "iva", "l", "la", "le", "les", "lo", "massima", "mittente", "nei", "nel", "nella", "nota", "o", "oggetto", "ore", "ove", "per",
    "persona", "piazza", "previo", "prof", "prot", "qualora", "quando", "quesito", "rag", "referente", "responsabile", "restano", "ricorrente", "risposta", "salvo", "se", "secondo",
    "segnalazione", "senza", "si", "sig", "signor", "signora", "sono", "sopralluogo", "su", "studio", "the", "this", "tribunale", "un", "una", "vista", "visto", "è",
))
ORGANISATIONS = frozenset((
    "azienda", "banca", "cantina", "comune", "consorzio", "cooperativa", "corte", "ditta", "fondazione", "impresa", "istituto", "liceo", "ospedale", "scuola", "società", "studio", "tenuta", "tribunale", "università",
))
# Words before a person's name, and words before "a" or "da" and a person's name.
BEFORE = (
    "referente", "ricorrente", "resistente", "sottoscritto", "sottoscritta", "teste", "testimone", "procedimento", "digitalmente", "presenti", "richiedente", "delegato", "delegata", "intestatario", "firmato",
    "dichiarante", "paziente", "dipendente", "cognome", "nominativo",
)
BEFORE_LINK = ("presentata", "presentato", "proposta", "proposto", "conferita", "conferito", "intestata", "intestato", "rilasciata", "rilasciato", "esibita", "esibito", "firmata", "firmato", "consegnata", "sportello")
TITLES = ("sig", "signor", "signora", "dott", "dottor", "dottoressa", "avv", "avvocato", "avvocata", "ing", "prof", "professor", "professoressa", "geom", "rag", "arch", "dr", "ra", "na", "ssa")
# First words of the kinds of street, as they are folded.
STREETS = (
    "via", "viale", "v", "vicolo", "vico", "piazza", "piazzale", "piazzetta", "p", "pzza", "corso", "c", "largo", "l", "salita", "contrada", "strada", "lungolago", "lungomare", "lungarno", "lungotevere",
    "borgo", "borgata", "calle", "galleria", "localita", "loc", "rione", "traversa",
)

_S = r"[^\S\r\n]*[\r\n]?[^\S\r\n]*"  # blanks with at most one line break
_AT = rf"(?:@|[(\[]{_S}(?:at|chiocciola|@){_S}[)\]]|(?<=\s)(?:chiocciola|at)(?=\s))"
_DOT = rf"(?:\.|{_S}[(\[]{_S}(?:punto|dot|\.){_S}[)\]]{_S}|\s{{1,3}}(?:punto|dot)\s{{1,3}})"
EMAIL_AT = re.compile(_AT, re.IGNORECASE)
EMAIL_DOMAIN = re.compile(rf"[A-Za-z0-9][A-Za-z0-9-]*(?:{_DOT}[A-Za-z0-9][A-Za-z0-9-]*)+", re.IGNORECASE)
BLANKS, BLANKS_END = re.compile(_S), re.compile(_S + "$")
PHONE = re.compile(
    r"(?<![\w/.,:+-])(?<!\w[ .-])?(?:(?:\+|00)39[\s.\-]{0,2})?(?:\(0\d{1,3}\)|0\d{1,3}|\(3\d{2}\)|3\d{2})[\s./\-]{0,2}\d{2,8}(?:[\s.\-]{1,2}\d{2,4}){0,3}(?![\w/]|[.,-]\d)"
)
TAX_CODE = re.compile(r"(?<!\w)[A-Z]{3}\s{0,2}[A-Z]{3}\s{0,2}[0-9LMNP-V]{2}[A-EHLMPRST][0-9LMNP-V]{2}\s{0,2}[A-Z][0-9LMNP-V]{3}[A-Z](?!\w)", re.IGNORECASE)
CARD = re.compile(r"(?<!\w)(?:[A-Z]{2}\d{5}[A-Z]{2}|[a-z]{2}\d{5}[a-z]{2}|[A-Z]{2}\s?\d{7}|[a-z]{2}\d{7})(?!\w)")
_KIND = r"(?:via|viale|v\.le|vicolo|vico|piazza|piazzale|piazzetta|p\.?zza|p\.za|p\.le|corso|c\.so|largo|l\.go|salita|contrada|c\.da|strada(?:\s+(?:vicinale|provinciale|statale|comunale))?|lungolago|lungomare|lungarno|lungotevere|borgo|borgata|calle|galleria|località|loc\.|rione|traversa)"
STREET_KIND = re.compile(rf"(?<![\w'’]){_KIND}(?=\s)", re.IGNORECASE)
_WORD = r"(?:(?:[dD]ell|[aA]ll|[dD]all|[sS]ant|[dD]|[lL]|DELL|ALL|SANT)['’]\s?)?(?:\p{Lu}[\p{L}'’.]*|\d{1,2}(?=\s+\p{Lu}))"
_LINK = r"(?:d[ieao]l?|dei|degli|delle|della|dello|al|alla|alle|ai|agli|allo|in|san|santa|e(?=\s+\p{Lu}\p{Ll})|DI|DEL|DEI|DEGLI|DELLE|DELLA|DELLO|AL|ALLA|ALLE|AI)"
_STREET = rf"(?<![\w'’])(?i:{_KIND})\s+(?:{_LINK}\s+)*{_WORD}(?:\s+(?:{_LINK}\s+)*{_WORD})*?"
STREET = regex.compile(_STREET + r"(?![\p{L}'’.])(?:\s+" + _WORD + r"(?!\w))*")
ADDRESS = regex.compile(
    _STREET + r"\s*,?\s*(?:n(?:um|r)?[.°º]{0,2}|n\.?°|civico|numero)?\s*\d{1,4}(?!\d)(?:\s?/\s?(?:[A-Za-z]|\d{1,3}|bis|ter)(?!\w)|[A-Za-z](?!\w)|\s(?:bis|ter|quater|BIS|TER)(?!\w)|\s[b-dB-DF-H](?![\w.'’]))?"
)
_PARTICLE = regex.compile(r"(?<![\p{L}\d])(?:De|Di|Del|Della|Dal|Dalla|Lo|DE|DI|DEL|DELLA|DAL)\s{1,3}$")
_TITLE = regex.compile(
    r"(?<!\p{L})(?:sig(?:\.ra|\.na|nor|nora)?|dott(?:\.ssa|or|oressa)?|avv(?:ocato|ocata)?|ing|prof(?:\.ssa|essor|essoressa)?|geom|rag|arch|dr(?:\.ssa)?)\.?\s{1,3}$", regex.IGNORECASE
)
_INITIAL = regex.compile(r"(?<![\p{L}\d./'’-])(?:\p{Lu}\.\s{0,3}){1,2}(?:(?:De|Di|Del|Della|Dal|DE|DI|DEL)\s{1,3})?(\p{Lu}[\p{L}]*(?:['’]\p{Lu}?[\p{L}]+)*)(?![\p{L}\d])")
_AFTER_INITIAL = regex.compile(r"\s{1,3}\p{Lu}\.(?!\p{L})(?=\s*[,;)]|\s+\p{Ll}|\s*$)")


_BEHIND = regex.compile(
    r"[\s,(]{1,4}(?:c\.?\s?f\.|codice\s+fiscale|nat[oa]\s+(?:a|il)\b|residente\b|domiciliat[oa]\b|documento\b|tel\b|cell\b|ha\s+depositato\b|prende\s+la\s+parola\b)", regex.IGNORECASE
)
BIRTH = re.compile(
    rf"(?:\bnat[oa](?:\s+(?:a|in)\s+[^\d,;.()]{{2,40}}?)?[\s,(]+il|\bdata\s+di\s+nascita:?)\s+(\d{{1,2}}([/.-])\d{{1,2}}\2\d{{4}}|\d{{1,2}}\s+(?:{'|'.join(MONTHS)})\s+\d{{4}})(?!\d)", re.IGNORECASE
)
_AND = re.compile(r",\s{1,3}|\s{1,2}ed?\s{1,2}")
_LOCAL = re.compile(r"[\w.+%-]")


def _fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)).casefold().rstrip("'’")


GIVEN = frozenset(map(_fold, GIVEN))
_LETTER, _CAPITAL, _DIGIT, _WORDCHAR, _BLANK, _MAIL = 1, 2, 4, 8, 16, 32


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every character of the basic plane: its classes as bits, and the folded letter."""
    kinds, fold = np.zeros(0x10000, np.uint8), np.zeros(0x10000, np.uint16)
    for k in range(0x10000):
        c = chr(k)
        if c.isalpha():
            low = unicodedata.normalize("NFD", c)[0].lower()
            fold[k] = min(ord(low[0]), 0xFFFF)
        word = c.isalnum() or c == "_"
        kinds[k] = _LETTER * c.isalpha() | _CAPITAL * c.isupper() | _DIGIT * c.isdecimal() | _WORDCHAR * word | _BLANK * c.isspace() | _MAIL * bool(_LOCAL.match(c))
    return kinds, fold


def _hashes(words: tuple | frozenset) -> dict[int, str]:
    """The words by their hashes."""
    if not (listed := sorted(words)):
        return {}
    codes = np.frombuffer(" ".join(listed).encode("utf-16-le"), np.uint16)
    ends = np.cumsum([len(w) + 1 for w in listed]) - 1
    starts = ends - [len(w) for w in listed]
    return dict(zip(span_hashes(codes, starts, ends).tolist(), listed, strict=True))


class _Lexicon:
    """Words that matter, found among millions of hashes by a table of their first bits."""

    def __init__(self, **kinds: tuple | frozenset) -> None:
        self.kinds = {name: _hashes(words) for name, words in kinds.items()}
        self.few = np.zeros(1 << 16, bool)
        for held in self.kinds.values():
            for h in held:
                self.few[h >> 48] = True

    def places(self, hashes: np.ndarray) -> dict[str, set[int]]:
        """Positions of the words of each kind."""
        at = np.flatnonzero(self.few[(hashes >> np.uint64(48)).astype(np.int64)])
        pairs = list(zip(at.tolist(), hashes[at].tolist(), strict=True))
        return {name: {i for i, h in pairs if h in held} for name, held in self.kinds.items()}


@functools.lru_cache(4)
def _lexicon(given: frozenset) -> _Lexicon:
    return _Lexicon(given=given, title=TITLES, street=STREETS, at=("at", "chiocciola"), before=BEFORE, link=("a", "da"), before_link=BEFORE_LINK)


def _surname(word: str, given: frozenset) -> bool:
    low = word.casefold()
    return len(word) >= 3 and low not in NO_NAME and _fold(word) not in given and low.split("'")[0].split("’")[0] not in {"l", "all", "dell", "nell", "sull", "dall"}


def _gap(text: str, a: int, b: int) -> bool:
    """Only white space, and not much, between two places."""
    return a < b <= a + 4 and text[a:b].isspace()


class Buffer:
    """Texts side by side (a zero between them) and what the bitmaps say about them."""

    def __init__(self, texts: list[str], given: frozenset = GIVEN) -> None:
        self.text, self.given = "\0".join(texts), given
        self.starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[: len(texts)]
        codes = np.minimum(np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF).astype(np.uint16)
        kinds, fold = _tables()
        self.codes, self.kinds = codes, kinds[codes]
        letter = np.concatenate([[False], self.kinds & _LETTER > 0, [False]])
        edges = np.flatnonzero(letter[1:] != letter[:-1])
        self.first, self.end = edges[::2], edges[1::2]
        self.found = _lexicon(given).places(span_hashes(fold[codes], self.first, self.end))
        self.digits = np.concatenate([[0], np.cumsum(self.kinds & _DIGIT > 0, dtype=np.int32)])
        self.before = np.concatenate([[0], self.kinds])[:-1] if len(codes) else self.kinds  # classes of the character before

    def has_digits(self, at: np.ndarray, ahead: int, least: int) -> np.ndarray:
        """The places with so many digits in the characters ahead."""
        return at[self.digits[np.minimum(at + ahead, len(self.codes))] - self.digits[at] >= least]

    def emails(self) -> Iterator[tuple[int, int]]:
        """Spans of addresses, sought around each sign or word for @."""
        signs = np.flatnonzero(self.codes == ord("@")).tolist()
        spots = sorted([(i, i + 1) for i in signs] + [(int(self.first[k]), int(self.end[k])) for k in self.found["at"]])
        stops, text, done = None, self.text, 0
        for a, b in spots:
            at = EMAIL_AT.search(text, max(0, a - 6), b + 6) if a >= done else None
            if not at or not at.start() <= a < at.end():
                continue
            if stops is None:
                stops = np.flatnonzero(self.kinds & _MAIL == 0)
            before = BLANKS_END.search(text, max(done, at.start() - 8), at.start()).start()
            k = int(np.searchsorted(stops, before)) - 1
            local = int(stops[k]) + 1 if k >= 0 else 0
            whole = done <= local < before and text[local].isascii() and text[local].isalnum() and text[before - 1] != "." and not (local and text[local - 1] == "/")
            domain = EMAIL_DOMAIN.match(text, BLANKS.match(text, at.end()).end()) if whole else None
            if domain:
                done = domain.end()
                yield local, done

    def _tried(self, places: np.ndarray, pattern: re.Pattern) -> Iterator[re.Match]:
        """Matches at the given places that do not overlap."""
        done = 0
        for i in places.tolist():
            if i >= done and (m := pattern.match(self.text, i)):
                done = m.end()
                yield m

    def phones(self) -> Iterator[tuple[int, int]]:
        begins = np.isin(self.codes, [ord(c) for c in "+(03"]) & (self.before & _WORDCHAR == 0)
        for m in self._tried(self.has_digits(np.flatnonzero(begins), 44, 9), PHONE):
            if _phone(self.text, m):
                yield m.span()

    def id_numbers(self) -> Iterator[tuple[int, int]]:
        latin = (self.codes < 128) & (self.kinds & _LETTER > 0)
        two = np.flatnonzero(latin[:-1] & latin[1:] & (self.before[:-1] & _WORDCHAR == 0)) if len(latin) > 1 else np.zeros(0, np.int64)
        size = len(self.codes)
        gaps = np.flatnonzero(self.kinds & _WORDCHAR == 0)
        k = np.searchsorted(gaps, two)
        run = (np.where(k < len(gaps), gaps[np.minimum(k, len(gaps) - 1)], size) if len(gaps) else np.full(len(two), size)) - two
        many = self.digits[np.minimum(two + 24, size)] - self.digits[two]
        for m in self._tried(two[(many >= 3) | (run == 16)], TAX_CODE):
            if any(c.isdigit() for c in m[0]) or _check_letter(_code(m[0])[:15]) == _code(m[0])[15]:
                yield m.span()
        for m in self._tried(self.has_digits(two, 10, 5), CARD):
            yield m.span()

    def streets(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Spans of addresses, and of all streets."""
        text, addresses, named = self.text, [], []
        for k in sorted(self.found["street"]):
            a, b = int(self.first[k]), int(self.end[k])
            if b - a == 1 and text[b : b + 1] != "." or not STREET_KIND.match(text, a):
                continue
            if m := ADDRESS.match(text, a):
                addresses.append(m.span())
            if street := m or STREET.match(text, a):
                named.append(street.span())
        return addresses, named

    def _capitals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, number of the first word) of capitalised words; parts joined by an apostrophe are one."""
        first, end, codes = self.first, self.end, self.codes
        none = np.zeros(0, np.int64)
        if not len(first):
            return none, none, none
        sign = codes[np.minimum(end[:-1], len(codes) - 1)]
        joined = (first[1:] - end[:-1] == 1) & ((sign == ord("'")) | (sign == 0x2019))
        group = np.concatenate([[0], np.cumsum(~joined)])
        capital = np.flatnonzero(self.kinds[first] & _CAPITAL > 0)
        leads = np.full(group[-1] + 1, len(first))
        np.minimum.at(leads, group[capital], capital)
        last = np.searchsorted(group, np.arange(group[-1] + 1), side="right") - 1
        held = leads < len(first)
        lead, stop = leads[held], end[last[held]]
        free = (self.before[first[lead]] & _DIGIT == 0) & (self.kinds[np.minimum(stop, len(codes) - 1)] & _DIGIT == 0)
        return first[lead[free]], stop[free], lead[free]

    def _cued(self, word: int, a: int) -> bool:
        """Whether the words before the given one show that a person's name follows at `a`."""
        k = word - 1
        if k < 0 or a - self.end[k] > 4 or self.text[self.end[k] : a].strip(": \t\n\r\xa0"):
            return False  # a full stop ends what the word before could show
        if k in self.found["before"]:
            return True
        return k in self.found["link"] and k - 1 in self.found["before_link"] and self.first[k] - self.end[k - 1] <= 2

    def names(self, blocked: list[tuple[int, int]], others: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Spans of names outside the blocked spans, which are sorted and do not overlap; `others` are names found before."""
        start, stop, word = self._capitals()
        if len(start) < 2:
            return
        solid = np.concatenate([[0], np.cumsum(self.kinds & _BLANK == 0, dtype=np.int32)])
        space = start[1:] - stop[:-1]
        near = (space >= 1) & (space <= 4) & (solid[start[1:]] == solid[stop[:-1]])
        chain = np.concatenate([[0], np.cumsum(~near)])
        lows = np.flatnonzero(np.concatenate([[True], ~near]))
        highs = np.append(lows[1:], len(start))
        given, title = self.found["given"], self.found["title"]
        listed = np.zeros(len(self.first) + 1, bool)
        listed[[*given, *title]] = True
        hit = listed[word] | listed[np.maximum(word - 1, 0)]
        hits = np.bincount(chain, weights=hit, minlength=len(lows)) > 0
        outs = [a for a, _ in blocked], [b for _, b in blocked]
        blocked_from, blocked_to = (np.array(x, np.int64) for x in outs)
        last, ends = -1, [b for _, b in others]
        for c in np.flatnonzero(highs - lows >= 2).tolist():
            lo, hi = int(lows[c]), int(highs[c])
            spans = list(zip(start[lo:hi].tolist(), stop[lo:hi].tolist(), strict=True))
            k = int(np.searchsorted(blocked_to, spans[0][0], side="right"))
            if k < len(blocked) and blocked_from[k] < spans[-1][1]:
                spans = [(a, b) for a, b in spans if not any(x < b and a < y for x, y in blocked[k : k + len(spans) + 1])]
                if len(spans) < 2:
                    continue
            found = list(_listed_names(self.text, spans, self.given)) if hits[c] else []
            k = bisect_right(ends, spans[0][0])
            last = max(last, ends[k - 1] if k else -1)
            listed_too = last >= 0 and spans[0][0] - last <= 5 and _AND.fullmatch(self.text, last, spans[0][0])
            begins = self._cued(int(word[lo]), spans[0][0]) or listed_too or _TITLE.search(self.text, max(0, spans[0][0] - 16), spans[0][0])
            if begins or not found and (_BEHIND.match(self.text, spans[min(len(spans), 3) - 1][1]) or _BEHIND.match(self.text, spans[1][1])):
                shown = _shown_name(self.text, spans, self.given)
                if shown and (not found or shown[0][0] <= found[0][0] and shown[0][1] == found[0][1]):
                    found[:1] = shown
            if found:
                last = found[-1][1]
            yield from found

    def initials(self, surnames: set[str]) -> Iterator[tuple[int, int]]:
        """Spans of initials before a surname, or after one that a title or another name of the texts shows to be one."""
        text, done = self.text, 0
        single = (self.end - self.first == 1) & (self.kinds[self.first] & _CAPITAL > 0) if len(self.first) else np.zeros(0, bool)
        for k in np.flatnonzero(single).tolist():
            a = int(self.first[k])
            if a < done or text[a + 1 : a + 2] != ".":
                continue
            if (m := _INITIAL.match(text, a)) and _surname(m[1], self.given) and (len(m[1]) > 3 or not m[1].isupper()):
                done = m.end()
                yield m.span()
            elif k and (m := _AFTER_INITIAL.match(text, int(self.end[k - 1]))) and m.end() == a + 2:
                low, end = int(self.first[k - 1]), int(self.end[k - 1])
                if text[low].isupper() and _surname(text[low:end], self.given) and (_fold(text[low:end]) in surnames or _TITLE.search(text, max(0, low - 16), low)):
                    done = a + 2
                    yield low, done


def _listed_names(text: str, outside: list[tuple[int, int]], given: frozenset) -> Iterator[tuple[int, int]]:
    """Names among neighbouring capitalised words, by given names and titles."""
    words = [text[a:b] for a, b in outside]
    known = [_fold(w) in given for w in words]
    done, i = -1, 0
    organised = lambda p: p > 0 and words[p - 1].casefold().split("'")[-1].split("’")[-1] in ORGANISATIONS and _gap(text, outside[p - 1][1], outside[p][0])
    while i < len(words):
        a, b = outside[i]
        if not known[i]:
            title = a >= done and i + 1 < len(words) and not known[i + 1] and _TITLE.search(text, max(0, a - 16), a)
            if title and (shown := _shown_name(text, outside[i:], given)):
                done = shown[0][1]
                yield shown[0]
                i = next((k for k in range(i, len(words)) if outside[k][0] >= done), len(words))
                continue
            i += 1
            continue
        j = i
        while j + 1 < len(words) and known[j + 1] and _gap(text, outside[j][1], outside[j + 1][0]):
            j += 1
        stop = outside[j][1]
        left = right = None
        if i and _gap(text, outside[i - 1][1], a) and _surname(words[i - 1], given) and outside[i - 1][0] >= done:
            left = i - 1
        r = j + 1
        if r < len(words) and _gap(text, stop, outside[r][0]):
            if words[r].casefold() in PARTICLES and r + 1 < len(words) and _gap(text, outside[r][1], outside[r + 1][0]) and _surname(words[r + 1], given):
                right = r + 1
            elif _surname(words[r], given):
                right = r
        if left is not None and right is not None:
            broken = lambda x, y: "\n" in text[x:y]
            if broken(outside[left][1], a) and not broken(stop, outside[j + 1][0]):
                left = None
            else:
                right = None
        if left is not None and not organised(left):
            start = outside[left][0]
            particle = _PARTICLE.search(text, max(0, start - 10), start)
            start = particle.start() if particle else start
            done = stop
            yield start, stop
        elif right is not None and not organised(i):
            done = outside[right][1]
            yield a, done
            j = max(j, right)
        i = j + 1


def _shown_name(text: str, spans: list[tuple[int, int]], given: frozenset) -> list[tuple[int, int]]:
    """The name at the start of neighbouring capitalised words of which the context says that they name a person."""
    whole = next((k for k in range(1, len(spans)) if not _gap(text, spans[k - 1][1], spans[k][0])), len(spans))
    spans = spans[:whole]
    words = [text[a:b] for a, b in spans]
    low = [w.casefold() for w in words]
    if len(words) < 2:
        return []
    n = 3 if len(words) > 2 and (low[0] in PARTICLES or low[1] in PARTICLES) else 2
    if len(words) == n + 1 and "\n" not in text[spans[n - 1][1] : spans[n][0]] and _surname(words[n], frozenset()):
        n += 1
    named = [w for w, x in zip(words[:n], low, strict=False) if x not in PARTICLES]
    if len(named) < 2 or not all(_surname(w, frozenset()) and w.casefold() not in ORGANISATIONS for w in named):
        return []
    return [(spans[0][0], spans[n - 1][1])]


PARTICLES = frozenset(("de", "di", "del", "della", "dal", "dalla", "lo"))


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _national(value: str) -> tuple[str, str]:
    """(country prefix, digits of the national number) of a phone number."""
    found = _digits(value)
    if re.match(r"(?:\+|00)39", value):
        cut = 2 if value.startswith("+") else 4
        return found[:cut], found[cut:]
    return "", found


def _phone(text: str, m: re.Match) -> bool:
    if re.search(r"(?:IVA|[Pp]rot\.?|CUP|CIG|[Nn]\.|euro|EUR)\s*$", text[max(0, m.start() - 8) : m.start()]):
        return False
    own = _national(m[0])[1]
    return 9 <= len(own) <= 10 if own.startswith(("3", "0")) else False


def scan_texts(texts: list[str | None], given: frozenset = GIVEN, dates: bool = False) -> Iterator[tuple[int, list[tuple[int, int, str]]]]:
    """(text number, its finds) of texts with finds: start, end and kind, in order, without overlaps.

    With `dates` dates of birth are found too, as 'birth_date'.
    """
    held: list[int] = []
    total = 0
    for i, t in enumerate(texts):
        if t:
            held.append(i)
            total += len(t)
        if held and (total >= TEXT_CHARS or i + 1 == len(texts)):
            for k, found in _scan_group([texts[j] for j in held], given, dates):
                yield held[k], found
            held, total = [], 0


def _scan_group(texts: list[str], given: frozenset, dates: bool) -> Iterator[tuple[int, list[tuple[int, int, str]]]]:
    buf = Buffer(texts, given)
    blocked = list(buf.emails())
    found = [(a, b, "email") for a, b in blocked]
    found += [(a, b, "phone") for a, b in buf.phones()]
    found += [(a, b, "id_number") for a, b in buf.id_numbers()]
    addresses, streets = buf.streets()
    found += [(a, b, "address") for a, b in addresses]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(blocked + streets):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    names = list(buf.names(merged, list(buf.initials(set()))))
    surnames: dict[int, set[str]] = {}
    owner = lambda at: int(np.searchsorted(buf.starts, at, side="right")) - 1
    for a, b in names:
        surnames.setdefault(owner(a), set()).update(_fold(w) for w in buf.text[a:b].split() if _fold(w) not in given)
    known = {w for ws in surnames.values() for w in ws}
    begins, ends = np.array([a for a, _ in merged], np.int64), np.array([b for _, b in merged], np.int64)
    for a, b in buf.initials(known):
        k = int(np.searchsorted(ends, a, side="right"))
        before = buf.text[a : a + 2].endswith(".")
        if (k == len(merged) or begins[k] >= b) and (before or _fold(buf.text[a:b].split()[0]) in surnames.get(owner(a), ()) or _TITLE.search(buf.text, max(0, a - 16), a)):
            names.append((a, b))
    found += [(a, b, "name") for a, b in names]
    if dates:
        found += [(*m.span(1), "birth_date") for m in BIRTH.finditer(buf.text) if _date(m[1])]
    rank = {k: n for n, k in enumerate((*KINDS, "birth_date"))}
    found.sort(key=lambda x: (x[0], -x[1], rank[x[2]]))
    kept: list[tuple[int, int, str]] = []
    for f in found:
        if not kept or f[0] >= kept[-1][1]:
            kept.append(f)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for a, b, kind in kept:
        k = owner(a)
        low = int(buf.starts[k])
        out.setdefault(k, []).append((a - low, b - low, kind))
    yield from out.items()


def scan(text: str | None, given: frozenset = GIVEN, dates: bool = False) -> list[tuple[int, int, str]]:
    """Start, end and kind of all finds in a text, in order, without overlaps."""
    return next((found for _, found in scan_texts([text], given, dates)), [])


def feistel(value: int, size: int, key: bytes, tweak: bytes, rounds: int = 10, back: bool = False) -> int:
    """Keyed permutation of 0 .. size - 1 (and its inverse): unbalanced Feistel network with cycle walking."""
    if size < 2:
        return value
    a = math.isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, a)
        for r in reversed(range(rounds)) if back else range(rounds):
            x = left if back else right
            f = int.from_bytes(hashlib.blake2b(x.to_bytes(16, "big") + bytes([r]) + tweak, key=key, digest_size=16).digest(), "big")
            left, right = ((right - f) % a, left) if back else (right, (left + f) % a)
        value = left * a + right
        if value < size:
            return value


def _permuted(values: list[int], sizes: list[int], key: bytes, tweak: str, back: bool) -> list[int]:
    """The numbers, each below its size, permuted together."""
    number = 0
    for v, n in zip(values, sizes, strict=True):
        number = number * n + v
    number = feistel(number, math.prod(sizes), key, tweak.encode(), back=back)
    out = []
    for n in reversed(sizes):
        number, v = divmod(number, n)
        out.append(v)
    return out[::-1]


def _in_place(value: str, signs: str) -> str:
    """The value with its digits and Latin letters replaced in order, in their case; all other signs stay."""
    rest = iter(signs)
    return "".join((next(rest).upper() if c.isupper() else next(rest).lower()) if c.isascii() and c.isalnum() else c for c in value)


# What the letters of a tax code stand for.
_MONTH_LETTERS, _OMOCODE = "ABCDEHLMPRST", "LMNPQRSTUV"
_ODD = {c: n for chars in ("0123456789", "ABCDEFGHIJ") for c, n in zip(chars, (1, 0, 5, 7, 9, 13, 15, 17, 19, 21), strict=True)} | dict(
    zip("KLMNOPQRSTUVWXYZ", (2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23), strict=True)
)
_DIGIT_PLACES = (6, 7, 9, 10, 12, 13, 14)


def _code(value: str) -> str:
    return "".join(c for c in value if c.isalnum()).upper()


def _check_letter(first: str) -> str:
    """Check letter of the first 15 signs of a tax code."""
    even = lambda c: int(c) if c.isdigit() else ord(c) - 65
    return chr(65 + sum(even(c) if k % 2 else _ODD[c] for k, c in enumerate(first)) % 26)


def tax_code_pseudonym(value: str, key: bytes, back: bool = False) -> str | None:
    """A tax code of the same form with a right check letter; None if the value is none.  Letters that stand for digits are read as these."""
    code = _code(value)
    if len(code) != 16 or not code.isascii() or not TAX_CODE.fullmatch(code) or _check_letter(code[:15]) != code[15]:
        return None
    plain = [str(_OMOCODE.index(c)) if k in _DIGIT_PLACES and c.isalpha() else c for k, c in enumerate(code)]
    day = int(plain[9] + plain[10])
    if not (1 <= day <= 31 or 41 <= day <= 71):
        return None
    fields = [ord(c) - 65 for c in plain[:6]] + [int(plain[6] + plain[7]), _MONTH_LETTERS.index(plain[8]), day - 1 if day <= 31 else day - 10, ord(plain[11]) - 65, int("".join(plain[12:15]))]
    *letters, year, month, day, town, place = _permuted(fields, [26] * 6 + [100, 12, 62, 26, 1000], key, "tax code", back)
    made = "".join(chr(65 + x) for x in letters) + f"{year:02d}{_MONTH_LETTERS[month]}{day + 1 if day < 31 else day + 10:02d}{chr(65 + town)}{place:03d}"
    return _in_place(value, made + _check_letter(made))


_DAYS = (dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal())


def _date(value: str) -> dt.date | None:
    parts = re.findall(r"\d+|[A-Za-z]+", value)
    month = MONTHS.index(parts[1].lower()) + 1 if parts[1].isalpha() else int(parts[1])
    try:
        found = dt.date(int(parts[2]), month, int(parts[0]))
    except ValueError:
        return None
    return found if _DAYS[0] <= found.toordinal() < _DAYS[1] else None


def date_pseudonym(value: str, key: bytes, back: bool = False) -> str:
    """Another date from 1900 to 2099, written as the given one."""
    (day,) = _permuted([_date(value).toordinal() - _DAYS[0]], [_DAYS[1] - _DAYS[0]], key, "date", back)
    new = dt.date.fromordinal(day + _DAYS[0])
    sign = re.search(r"[/.-]", value)
    return new.strftime(f"%d{sign[0]}%m{sign[0]}%Y") if sign else f"{new.day} {MONTHS[new.month - 1]} {new.year}"


def phone_pseudonym(value: str, key: bytes, back: bool = False) -> str:
    """The number with its national part permuted behind the first digit; prefix, blanks and brackets stay."""
    prefix, own = _national(value)
    rest = _permuted([int(c) for c in own[1:]], [10] * (len(own) - 1), key, f"phone {own[:1]} {len(own)}", back)
    return _in_place(value, prefix + own[:1] + "".join(map(str, rest)))


def pseudonym(value: str, key: bytes, kind: str, back: bool = False) -> str:
    """The value permuted within its format.  Equal values up to case and separators get equal signs, so they stay linked across documents."""
    if kind == "phone":
        return phone_pseudonym(value, key, back)
    if kind == "birth_date":
        return date_pseudonym(value, key, back)
    if kind == "id_number" and (made := tax_code_pseudonym(value, key, back)):
        return made
    signs = [c for c in value.lower() if c.isascii() and c.isalnum()]
    sizes = [10 if c.isdigit() else 26 for c in signs]
    tweak, values = kind + "".join("9" if n == 10 else "a" for n in sizes), [int(c) if c.isdigit() else ord(c) - 97 for c in signs]
    while True:  # again where it comes out as a right tax code, so that those are permuted among themselves
        values = _permuted(values, sizes, key, tweak, back)
        made = _in_place(value, "".join(str(x) if n == 10 else chr(97 + x) for x, n in zip(values, sizes, strict=True)))
        if kind != "id_number" or tax_code_pseudonym(made, key) is None:
            return made


def placeholder(value: str, kind: str, key: bytes) -> str:
    """Typed placeholder: [PHONE 0612 345678] for numbers and dates, [NAME K5QX2A] for the other kinds."""
    if kind in ("phone", "id_number", "birth_date"):
        return f"[{kind.upper()} {pseudonym(value, key, kind)}]"
    plain = _fold(value).split()
    plain = " ".join(sorted(plain) if kind == "name" else plain)  # a name in either order
    tag = base64.b32encode(hashlib.blake2b(plain.encode(), key=key, person=kind.encode()).digest()[:5]).decode()
    return f"[{kind.upper()} {tag}]"


def _redacted(text: str, found: list[tuple[int, int, str]], key: bytes) -> str:
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], placeholder(text[a:b], kind, key)]
        at = b
    return "".join([*out, text[at:]])


def redact_text(text: str | None, key: bytes, given: frozenset = GIVEN) -> str | None:
    return _redacted(text, scan(text, given, dates=True), key) if text else text


def find(documents: DataFrame, given: frozenset = GIVEN) -> DataFrame:
    """doc_id, pii_kind, found_text of all finds, each once.  One narrow pass; only the finds are shuffled."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            rows = {(ids[i], k, texts[i][a:b]) for i, found in scan_texts(texts, given) for a, b, k in found}
            yield pd.DataFrame(list(rows), columns=["doc_id", "pii_kind", "found_text"])

    picked = spread(documents.where(F.col("text").isNotNull()).select("doc_id", "text"), "doc_id")
    return picked.mapInPandas(work, f"doc_id {kind}, pii_kind string, found_text string").distinct()


def redact(documents: DataFrame, key: bytes, given: frozenset = GIVEN) -> DataFrame:
    """The documents with `text` redacted: one narrow pass, other columns untouched."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            texts = [t if isinstance(t, str) else None for t in s]
            done = list(texts)
            for i, found in scan_texts(texts, given, dates=True):
                done[i] = _redacted(texts[i], found, key)
            yield pd.Series(done, index=s.index, dtype=object)

    return documents.withColumn("text", clean("text"))
