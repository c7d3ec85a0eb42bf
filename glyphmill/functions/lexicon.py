"""Word lists that drive the deterministic models; any other lists can be passed in."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from glyphmill.functions.text import WORD

# Java looks back by whole code points only if the pattern itself holds one beyond
# U+FFFF. U+10000 is a letter, so naming it changes nothing else.
_WORD_BEFORE = WORD.replace("]", "\U00010000]")
_WORD_ONLY = re.compile(r"\w+")


# The unit of a text and the score made of it.
def unit_of(text: str) -> float:
    """Driver/worker twin of ``functions.text.stable_unit``."""
    return int.from_bytes(hashlib.sha256(text.encode("utf-8")).digest()[:4], "big") / 0xFFFFFFFF


def term_score(term: str) -> float:
    """Score of an entity; it depends on the lower-cased term alone."""
    return round(0.7 + 0.29 * unit_of(term), 4)


@dataclass(frozen=True)
class PolarityLexicon:
    """Lower-case words that count as positive or negative evidence."""

    positive: frozenset[str]
    negative: frozenset[str]

    @classmethod
    def of(cls, positive: Iterable[str], negative: Iterable[str]) -> PolarityLexicon:
        return cls(frozenset(positive), frozenset(negative))


@dataclass(frozen=True)
class EntityLexicon:
    """Lower-case terms by entity type, in order of priority.

    A term listed under several types belongs to the first of them.
    """

    by_type: tuple[tuple[str, frozenset[str]], ...]

    @classmethod
    def of(cls, by_type: Mapping[str, Iterable[str]]) -> EntityLexicon:
        return cls(tuple((kind, frozenset(terms)) for kind, terms in by_type.items()))

    def term_types(self) -> dict[str, str]:
        """Term -> type for every term a token can equal, sorted by term."""
        found: dict[str, str] = {}
        for kind, terms in self.by_type:
            for term in terms:
                found.setdefault(term, kind)
        return {term: found[term] for term in sorted(found) if surface_forms(term)}


def surface_forms(term: str) -> list[str]:
    """Spellings a token that lower-cases to ``term`` can be searched by, ignoring case.

    Only runs of word characters are tokens. The one letter whose lower case is
    longer than itself (U+0130, which becomes "i" and U+0307) needs its own form.
    """
    form = term.replace("i̇", "İ")
    return [form] if _WORD_ONLY.fullmatch(form) else []


def term_pattern(terms: Iterable[str]) -> str:
    """A Java pattern for whole tokens that may lower-case to one of ``terms``.

    Ignoring case finds a little more than lower-casing does, so callers look the
    lower-cased match up again. Terms that no token can equal are left out; a
    pattern of no terms matches nothing.
    """
    forms = sorted({form for term in terms for form in surface_forms(term)}, key=lambda form: (-len(form), form))
    if not forms:
        return "(?!)"
    # The first letter is the cheapest test, and it fails at most positions.
    initials = "".join(sorted({form[0] for form in forms}))
    return f"(?iu)(?=[{initials}])(?<!{_WORD_BEFORE})(?:{'|'.join(forms)})(?!{WORD})"


# The default Spanish word lists.
SPANISH_POLARITY = PolarityLexicon.of(
    positive=[
        "excelente", "bueno", "buena", "claro", "clara", "útil", "recomiendo", "positivo",
        "ganancia", "sube", "fuerte", "crece", "favorable", "satisfecho", "ordenado",
    ],
    negative=[
        "malo", "mala", "pésimo", "pésima", "desorganizado", "confuso", "caída", "pérdida",
        "riesgo", "negativo", "baja", "débil", "cae", "deficiente", "insatisfecho", "lento",
    ],
)
SPANISH_CLINICAL = EntityLexicon.of(
    {
        "FARMACO": [
            "ibuprofeno", "paracetamol", "amoxicilina", "omeprazol", "metformina", "aspirina",
            "diazepam", "losartán", "atorvastatina", "naproxeno",
        ],
        "SINTOMA": [
            "cefalea", "dolor", "náusea", "nausea", "fiebre", "mareo", "erupción", "vómito",
            "vomito", "fatiga", "tos", "diarrea", "prurito",
        ],
    }
)
