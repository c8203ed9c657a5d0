"""Labelled examples for the trees of ``pii``: made-up personal data, and look-alikes, planted in the corpus.

Values are checked, not copied: card numbers have a Luhn digit, address parts are at most 255, phone numbers
have 9 to 15 digits. Look-alikes have the same shapes and are none: dates, ranges, amounts, rows of
tables, part numbers, failing cards, versions, prose around "at". Each list has formats to fit on and, as
``HELD_OUT``, others that only set the thresholds.
"""

from __future__ import annotations

import random

# Words of made-up addresses.
NAMES = ("john", "m.schmidt", "ana_lopez", "info", "j.doe84", "sales-team", "claire", "peter.k", "x9", "support")
HOSTS = ("example", "mail-box", "acme", "uni-koeln", "shop24", "contact", "my.company", "web")
TLDS = ("com", "org", "net", "de", "fr", "es", "io", "co.uk", "edu", "info")
# Words that announce a kind, in four languages.
CUES = {"email": ("mail", "e-mail", "write to", "contact", "correo", "courriel"),
        "ip": ("ip", "host", "server", "address", "adresse"),
        "card": ("card", "visa", "karte", "tarjeta", "carte", "paid with"),
        "phone": ("tel", "phone", "call", "fax", "mobile", "telefon", "teléfono", "téléphone")}


def digits(rng: random.Random, n: int, first: str = "123456789") -> str:
    return rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(n - 1))


def luhn_digit(number: str) -> str:
    """The digit that makes ``number`` pass."""
    total = 0
    for at, d in enumerate(reversed(number)):
        n = int(d) * (1 if at % 2 else 2)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def card(rng: random.Random, passing: bool = True) -> list[str]:
    """Groups of a card number; a failing one has a wrong last digit."""
    sizes = rng.choice(((4, 4, 4, 4), (4, 4, 4, 4), (4, 6, 5)))
    body = digits(rng, sum(sizes) - 1, "3456")
    last = luhn_digit(body)
    number = body + (last if passing else str((int(last) + rng.randrange(1, 10)) % 10))
    groups, at = [], 0
    for n in sizes:
        groups.append(number[at:at + n])
        at += n
    return groups


def octets(rng: random.Random) -> list[str]:
    return [str(rng.choice((10, 172, 192, rng.randrange(1, 256)))), *[str(rng.randrange(256)) for _ in range(3)]]


def address(rng: random.Random) -> tuple[str, str, str]:
    host, tld = rng.choice(HOSTS), rng.choice(TLDS)
    return rng.choice(NAMES), host, tld


def _mail(at: str, dot: str):
    def make(rng):
        name, host, tld = address(rng)
        return f"{name}{at}{f'{host}.{tld}'.replace('.', dot)}"
    return make


def _joined(parts, by: str):
    return lambda rng: by.join(parts(rng))


def _phone(*sizes: int, form: str):
    """``form`` with each {} filled with a group of that many digits; {0} stands for a leading zero."""
    def make(rng):
        return form.format(*[digits(rng, n, "23456789" if at == 0 else "0123456789") for at, n in enumerate(sizes)])
    return make


def _defanged(rng: random.Random) -> str:
    a, b, c, d = octets(rng)
    return f"{a}.{b}.{c}[.]{d}"


FORMATS = {
    "email": [_mail(" [at] ", "."), _mail("(at)", "."), _mail(" at ", " dot "), _mail(" [at] ", " [dot] "),
              _mail(" @ ", " . "), _mail(" at ", "."), _mail("[at]", "[dot]")],
    "ip": [_joined(octets, " . "), _joined(octets, "[.]"), _joined(octets, " dot "), _defanged],
    "card": [_joined(card, "."), _joined(card, "/"), _joined(card, " - "), _joined(card, "  ")],
    "phone": [_phone(3, 3, 4, form="({}) {}-{}"), _phone(3, 3, 4, form="{}-{}-{}"), _phone(3, 3, 4, form="{}.{}.{}"),
              _phone(3, 4, 4, form="0{} {} {}"), _phone(3, 7, form="0{}/{}"), _phone(3, 3, 4, form="{} {} {}"),
              _phone(3, 3, 4, form="1.{}.{}.{}"), _phone(3, 3, 4, form="1 ({}) {}-{}"), _phone(2, 4, 4, form="(0{}) {} {}"),
              _phone(3, 2, 2, 2, form="(0{}) {}-{}-{}"), _phone(2, 3, 4, form="0044 {} {} {}"),
              _phone(2, 8, form="00 33 {} {}"), _phone(3, 2, 2, 2, form="0{}.{}.{}.{}"),
              _phone(1, 2, 2, 2, 2, form="0{} {} {} {} {}")],
}
HELD_OUT = {
    "email": [_mail("(at)", "(dot)"), _mail(" (at) ", " dot "), _mail(" AT ", " DOT "), _mail(" {at} ", ".")],
    "ip": [_joined(octets, "(.)"), _joined(octets, " [.] "), _joined(octets, "[dot]")],
    "card": [_joined(card, "_"), _joined(card, " / "), _joined(card, " . ")],
    "phone": [_phone(3, 3, 4, form="1-{}-{}-{}"), _phone(2, 3, 2, 2, form="(0{}) {} {} {}"),
              _phone(2, 7, form="00 49 {} {}"), _phone(3, 3, 4, form="({}) {} {}")],
}


def _number(low: int, high: int):
    return lambda rng: str(rng.randrange(low, high))


def _row(make, low: int, high: int, by: str):
    return lambda rng: by.join(make(rng) for _ in range(rng.randrange(low, high)))


def _date(rng: random.Random) -> str:
    return f"{rng.randrange(1950, 2040)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"


def _clock(rng: random.Random) -> str:
    return f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}:{rng.randrange(60):02}"


def _prose_at(by: str):
    words = ("arrived", "look", "met", "she", "seven", "and", "thrown", "away", "one", "of")
    after = ("school", "noon", "this", "tihe", "home", "the", "least", "ninth", "last")
    then = ("Then", "We", "The", "in", "and", "Ersh", "or", "it", "But", "On")
    then += ("Es", "De", "Info", "es", "de", "io", "Net") if by[-1] == " " else ()
    return lambda rng: f"{rng.choice(words)} at {rng.choice(after)}{by}{rng.choice(then)}"


CONTRASTS = [
    _row(_number(1900, 2040), 3, 8, " "), _row(_number(1900, 2040), 3, 6, "-"), _row(_number(10, 100), 5, 12, " "),
    _row(_number(100, 1000), 3, 9, " "), _row(_number(1000, 100_000), 3, 7, " "), _row(_number(0, 30), 4, 9, ", "),
    _row(_number(0, 256), 4, 5, ", "), _row(_number(100, 100_000), 3, 6, ".  "),
    lambda rng: f"{_date(rng)} {rng.randrange(24):02}.{rng.randrange(60):02}.{rng.randrange(60):02}",
    lambda rng: f"{_date(rng)} - {_date(rng)}", _clock, _joined(lambda rng: card(rng, False), " "),
    _joined(lambda rng: card(rng, False), "."), _joined(lambda rng: card(rng, False), "-"),
    lambda rng: f"{digits(rng, 3)}-{digits(rng, 1)}-{digits(rng, 5)}-{digits(rng, 3)}-{digits(rng, 1)}",
    _prose_at(". "), _prose_at("."), _prose_at(" . "), lambda rng: f"go @ {rng.choice(HOSTS)} . Then",
    lambda rng: f"{rng.randrange(100)} @ {rng.randrange(9)}.{rng.randrange(99)}",
]
HELD_OUT_CONTRASTS = [
    _row(_number(1900, 2040), 3, 6, "/"), _row(_number(100, 1000), 4, 7, "  "), _row(_number(10, 10_000), 4, 9, " "),
    lambda rng: f"{_date(rng).replace('-', '.')} {_date(rng).replace('-', '.')}", _joined(lambda rng: card(rng, False), "/"),
    _row(_number(0, 200), 4, 5, " : "), _prose_at(" .  "), _prose_at(". "),
    lambda rng: f"{digits(rng, 6)}-{digits(rng, 6)}",
]


def planted(rng: random.Random, text: str, held_out: bool):
    """One example: (snippet, kind or None, start, end) with ``text``'s words around it. Half of the true ones
    have a word that announces them, some look-alikes have one too."""
    kind = rng.choice((*FORMATS, None, None, None))
    make = rng.choice((HELD_OUT_CONTRASTS if held_out else CONTRASTS) if kind is None
                      else (HELD_OUT if held_out else FORMATS)[kind])
    cue = ""
    if rng.random() < (0.15 if kind is None else 0.5):
        cue = rng.choice(CUES[kind or rng.choice(list(CUES))]) + rng.choice((" ", ": ", " is "))
    cut = text.find(" ", rng.randrange(len(text) + 1))
    cut = cut if cut >= 0 else 0
    left, right = text[max(0, cut - 40):cut], text[cut:cut + 40]
    span, after = make(rng), rng.choice(("", "", ".", ",", ";", ")"))
    before = f"{left} {cue}" + rng.choice(("", "", "("))
    return f"{before}{span}{after}{right if right[:1].isspace() else ' ' + right}", kind, len(before), len(before) + len(span)
