"""The small labelled table from which the personal-data model is trained: sentences
in which [kind:...] marks personal data, built from a few patterns by rule."""

from __future__ import annotations

import random

# Sentence patterns; {e} {i} {c} {p} stand for marked data, {n} for a
# number that is none, {w} for an ordinary word.
PATTERNS = [
    "write to {e} for the {w}", "{e}", "contact: {e}, or call {p}.", "mail {e} today",
    "the address is {e} and the phone is {p}", "please call {p} before noon", "{p}",
    "tel. {p}", "phone {p} or {e}", "fax: {p};", "{w} {w} {p} {w} {w}", "{w}, {w} {e} {w} {w}.",
    "server {i} is down", "{i}", "from {i} to {i}", "host {i}, port {n}", "{w} {i} {w} {w}",
    "ping {i}.", "card {c} was charged", "{c}", "pay with {c}, please", "{w} {w} {c} {w}.",
    "number {c} expires in {n}", "{w} {w} {w}, {w} {w}.", "{w} {w} in {n} {w}", "version {n} of {w}",
    "in {n} there were {n} {w}", "{w} costs {n} a piece", "{w} {n}", "{n} {w}, {n} {w}; {n}.",
    "see http://{w}.example.org/{w}?id={n}", "{w} @{w} said {w}", "{w}={n} and {w}: {n}",
    "{w} {w}.{w} {w}", "{w} {w}.{w}.{w} {w}, {w}", "{w}*** {w}### {w}$$$ {w}&&&", "{w} | {w} | {w}, | {w}.", "{w}!! {w}!! {w}!!", "{w}: {w}/{w}",
]
# Ordinary words and numbers that are no personal data.
WORDS = ["the", "order", "is", "late", "Monday", "report", "and", "of", "with", "Then", "number",
         "total", "maison", "für", "año", "été", "größe", "It", "in", "a", "value", "code"]
NUMBERS = ["1", "12", "2021", "1,000", "3.50", "2.4.1", "10:30", "2020-01-31", "31.12.1999", "50%",
           "#4711", "12345", "200000", "A12", "4th", "v2", "0x1f", "1/2", "7-8", "1984,", "(3)",
           "AB12CD34", "1e9", "404182", "b7db7aa4"]


def _digits(draw: random.Random, pattern: str) -> str:
    return "".join(str(draw.randint(0, 9)) if c == "d" else c for c in pattern)


def _email(draw: random.Random) -> str:
    name = draw.choice(["jane.doe", "j_smith", "info", "a.b-c", "bosbt.42", "Tom99", "hk+x"])
    host = draw.choice(["example.com", "mail8.example.com", "uni-x.example.org", "corp.example.net"])
    return draw.choice([f"{name}@{host}", f"{name}@{host}", f"{name}[at]{host}", f"{name}(at){host}"])


def _phone(draw: random.Random) -> str:
    return _digits(draw, draw.choice(["+d (ddd) ddd-dddd", "+dd ddd ddddddd", "+d.ddd.ddd.dddd",
                                      "+dd (d) ddd dddddd", "(ddd) ddd-dddd", "ddd-ddd-dddd",
                                      "+ddddddddddd"]))


def _address(draw: random.Random) -> str:
    return ".".join(str(draw.randint(1, 255)) for _ in range(4))


def _card(draw: random.Random) -> str:
    return _digits(draw, draw.choice(["dddddddddddddddd", "dddd dddd dddd dddd",
                                      "dddd-dddd-dddd-dddd", "dddd.dddd.dddd.dddd"]))


def labelled_table(rounds: int = 12, seed: int = 7) -> list[str]:
    """``rounds`` sentences from every pattern, always the same ones."""
    draw = random.Random(seed)
    make = {"e": lambda: f"[email:{_email(draw)}]", "i": lambda: f"[ip:{_address(draw)}]",
            "c": lambda: f"[card:{_card(draw)}]", "p": lambda: f"[phone:{_phone(draw)}]",
            "n": lambda: draw.choice(NUMBERS), "w": lambda: draw.choice(WORDS)}
    out = []
    for _ in range(rounds):
        for pattern in PATTERNS:
            text = pattern
            for mark, value in make.items():
                while f"{{{mark}}}" in text:
                    text = text.replace(f"{{{mark}}}", value(), 1)
            out.append(text)
    return out
