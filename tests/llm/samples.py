"""Documents with odd texts, and prose of invented words."""

from __future__ import annotations

import random

# Names the operators use inside; none of them may get in the way.
CLASHING = {"score": 1.5, "k1": 7, "h": 3, "row": "r", "text_": "t", "component_id": 9, "_text": "x", "short": "s",
            "n_lines": 4, "hash.ed": 1, "base_failed": True, "label": 0, "node": 1}

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, k1 long, h long, row string, "
    "text_ string, component_id long, _text string, short string, n_lines long, `hash.ed` long, base_failed boolean, "
    "label long, node long"
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = ["ta", "re", "mon", "li", "ker", "su", "pa", "vor", "eth", "in"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    original = prose(1, 120)
    words = original.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    far = " ".join([*words[:60], *prose(2, 60).split()])
    long = prose(3, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, original),
        (5, near),
        (6, original),
        (6, original),
        (7, far),
        (8, "One two"),
        (9, "one TWO"),
        (10, "\n\n" + original + "\n" + original + "\n"),
        (11, long),
        (12, long + " tail"),
        (None, original),
        (None, None),
        (13, "É é ÀB x 😀 mail me: a.b@c-d.org, +1 (555) 123-4567; 4111 1111 1111 1111 at 10.0.0.255"),
        (-5, "One  two\n"),
        (14, "x" * 100_000),
    ]
