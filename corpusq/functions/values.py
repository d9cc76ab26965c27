"""Character sets, language codes and markers that results depend on."""

SUSPICIOUS = r"@#$%^&*{}\[\]|\\<>~`_=+"
#: Characters beyond ASCII that clean French or German print has.
EXPECTED_EXTRA = "–—‘’“”«»àâäæçèéêëîïôöùûüÿœÀÂÄÆÇÈÉÊËÎÏÔÖÙÛÜŒß"
BLANK_MARKERS = ["blank page", "blank", "blank pages", "page blanche", "page vide"]
#: Bibliographic to terminological codes.
LANG_B2T = {"fre": "fra", "ger": "deu", "dut": "nld", "gre": "ell"}
LANG_2TO3 = {
    "fr": "fra", "de": "deu", "en": "eng", "it": "ita", "la": "lat", "es": "spa", "el": "ell", "nl": "nld", "pt": "por", "ru": "rus",
    "pl": "pol", "cs": "ces", "da": "dan", "sv": "swe", "fi": "fin", "hu": "hun", "ro": "ron", "tr": "tur", "ca": "cat",
}
TEI_FROM = "—„‚‹›    "
TEI_TO = "–“‘‘’    "
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŸ"
FOLD_TO = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY"
DIACRITICS = {"de": "äöüßÄÖÜ", "fr": "àâçéèêëîïôùûüÿœæÀÂÇÉÈÊËÎÏÔÙÛÜŸŒÆ", "es": "áéíóúñüÁÉÍÓÚÑÜ"}
STATUS_MIGRATION = {"view": "open", "click": "in_progress", "purchase": "done"}
