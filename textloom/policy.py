"""What differs between editions of a localization project, as one record."""

from __future__ import annotations

import re
from dataclasses import dataclass

# Length-ratio bounds by language pair, script ranges by language, locale tag form.
DEFAULT_RATIO = (0.08, 8.0)
PAIR_RATIOS = {
    ("ja", "zh"): (0.12, 4.0),
    ("ja", "en"): (0.20, 8.0),
    ("ja", "ko"): (0.12, 5.0),
    ("en", "de"): (0.20, 5.0),
    ("en", "es"): (0.20, 5.0),
    ("en", "fr"): (0.20, 5.0),
}
SCRIPTS = {
    "kana": "\u3041-\u309f\u30a0-\u30ff\uff66-\uff9f",
    "han": "\u3400-\u9fff\uf900-\ufaff",
    "hangul": "\u1100-\u11ff\u3130-\u318f\uac00-\ud7af",
    "cyrillic": "\u0400-\u052f",
    "greek": "\u0370-\u03ff\u1f00-\u1fff",
    "arabic": "\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff",
    "hebrew": "\u0590-\u05ff",
    "thai": "\u0e00-\u0e7f",
}
#: For each language the script that shows that it was left untranslated, and all that it is written in.
LANGUAGE_SCRIPT = {"ja": "kana", "zh": "han", "ko": "hangul", "ru": "cyrillic", "uk": "cyrillic", "bg": "cyrillic", "el": "greek", "ar": "arabic", "fa": "arabic", "ur": "arabic", "he": "hebrew", "th": "thai"}
WRITTEN_IN = {language: {script} for language, script in LANGUAGE_SCRIPT.items()} | {"ja": {"kana", "han"}, "ko": {"hangul", "han"}}
STRICT_KANA = "\u3041-\u3096\u30a1-\u30fa"
LOCALE = r"[A-Za-z]{2,3}(?:-[A-Za-z0-9]{2,8})*"


def language_of(locale: str | None) -> str:
    return (locale or "").split("-", 1)[0].casefold()


def locale_issues(source: str | None, target: str | None) -> list[str]:
    """What is wrong with a project's pair of locale tags."""
    found = [f"{name} is not a locale tag" for name, tag in (("source_locale", source), ("target_locale", target)) if not tag or not re.fullmatch(LOCALE, tag)]
    if source and target and source.casefold() == target.casefold():
        found.append("source_locale and target_locale must be different")
    return found


@dataclass(frozen=True)
class Policy:
    """Edition: which checks hold and with which bounds."""

    source_locale: str = ""
    target_locale: str = ""
    schema_version: int = 3
    check_nfc: bool = True
    term_modes: bool = True  # else every term is an exact substring
    filter_locales: bool = True
    residual_code: str = "residual-source-script"
    residual_class: str | None = None  # characters; None: by language
    ratio: tuple[float, float] | None = None  # None: by language pair

    def ratios(self) -> tuple[float, float]:
        return self.ratio or PAIR_RATIOS.get((language_of(self.source_locale), language_of(self.target_locale)), DEFAULT_RATIO)

    def residual(self) -> str | None:
        """A character class of scripts that the target must not have left, or None."""
        if self.residual_class is not None:
            return f"[{self.residual_class}]"
        script = LANGUAGE_SCRIPT.get(language_of(self.source_locale))
        if script is None or script in WRITTEN_IN.get(language_of(self.target_locale), set()):
            return None
        return f"[{SCRIPTS[script]}]"


def multilingual(source_locale: str, target_locale: str) -> Policy:
    return Policy(source_locale, target_locale)


def japanese_chinese() -> Policy:
    return Policy("ja", "zh-CN", schema_version=2, check_nfc=False, term_modes=False, filter_locales=False, residual_code="residual-kana", residual_class=STRICT_KANA, ratio=(0.12, 4.0))
