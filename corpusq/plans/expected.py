"""Values that the SQL of the queries uses, written apart from the operators' own: a wrong one on either side shows."""

#: Fixed values, for RE2 character classes and translate().
SUSPICIOUS = r"\x40\x23\x24\x25\x5E\x26\x2A\x7B\x7D\x5B\x5D\x7C\x5C\x3C\x3E\x7E\x60\x5F\x3D\x2B"
EXPECTED = (
    r"\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}\x{AB}\x{BB}\x{E0}\x{E2}\x{E4}\x{E6}\x{E7}\x{E8}-\x{EB}\x{EE}\x{EF}\x{F4}\x{F6}\x{F9}\x{FB}\x{FC}\x{FF}\x{153}"
    r"\x{C0}\x{C2}\x{C4}\x{C6}\x{C7}\x{C8}-\x{CB}\x{CE}\x{CF}\x{D4}\x{D6}\x{D9}\x{DB}\x{DC}\x{152}\x{DF}"
)
SUSPECT_CLASS = f"[{SUSPICIOUS}]|[^\\x00-\\x7F{EXPECTED}\\p{{Z}}]"
FOLD = (
    ("àáâãäå", "a"), ("ç", "c"), ("èéêë", "e"), ("ìíîï", "i"), ("ñ", "n"), ("òóôõö", "o"), ("ùúûü", "u"), ("ýÿ", "y"),
    ("ÀÁÂÃÄÅ", "A"), ("Ç", "C"), ("ÈÉÊË", "E"), ("ÌÍÎÏ", "I"), ("Ñ", "N"), ("ÒÓÔÕÖ", "O"), ("ÙÚÛÜ", "U"), ("ÝŸ", "Y"),
)
FOLD_FROM, FOLD_TO = "".join(a for a, _ in FOLD), "".join(b * len(a) for a, b in FOLD)
LANG_CODES = {
    "fre": "fra", "ger": "deu", "dut": "nld", "gre": "ell", "fr": "fra", "de": "deu", "en": "eng", "it": "ita", "la": "lat", "es": "spa", "el": "ell", "nl": "nld",
    "pt": "por", "ru": "rus", "pl": "pol", "cs": "ces", "da": "dan", "sv": "swe", "fi": "fin", "hu": "hun", "ro": "ron", "tr": "tur", "ca": "cat",
}
DIACRITICS = {"de": "äöüßÄÖÜ", "fr": "àâçéèêëîïôùûüÿœæÀÂÇÉÈÊËÎÏÔÙÛÜŸŒÆ", "es": "áéíóúñüÁÉÍÓÚÑÜ"}


def folded(c: str) -> str:
    """SQL: without accents, ß as ss; case stays."""
    return f"replace(translate({c}, '{FOLD_FROM}', '{FOLD_TO}'), 'ß', 'ss')"
