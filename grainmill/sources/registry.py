"""The public corpora of each language and how their files are selected."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Corpus:
    repo: str
    subset: str | None
    output: str

    @property
    def include(self) -> str | None:
        """Pattern of the files to fetch; None takes the whole repository."""
        return include_pattern(self.repo, self.subset)


#: Corpora by language as (repository, subset, output folder); fixed values.
CORPORA = {
    "ar": [
        ("HPLT/HPLT2.0_cleaned", "ara_Arab", "hplt2"),
        ("uonlp/CulturaX", "ar", "culturax"),
        ("lightonai/ArabicWeb24", None, "arabicweb24"),
        ("ClusterlabAi/101_billion_arabic_words_dataset", None, "clusterlab"),
        ("allenai/c4", "ar", "c4_ar"),
        ("HuggingFaceFW/fineweb-2", "arb_Arab", "fineweb2"),
        ("HuggingFaceFW/finepdfs", "arb_Arab", "finepdfs"),
    ],
    "tr": [
        ("HPLT/HPLT2.0_cleaned", "tur_Latn_1", "hplt2"),
        ("HuggingFaceFW/fineweb-2", "tur_Latn", "fineweb2"),
        ("uonlp/CulturaX", "tr", "culturax"),
        ("allenai/c4", "tr", "c4_tr"),
        ("vngrs-ai/vngrs-web-corpus", None, "vngrs"),
    ],
    "hi": [
        ("HPLT/HPLT2.0_cleaned", "hin_Deva", "hplt2"),
        ("HuggingFaceFW/fineweb-2", "hin_Deva", "fineweb2"),
        ("uonlp/CulturaX", "hi", "culturax"),
        ("allenai/c4", "hi", "c4_hi"),
        ("ai4bharat/sangraha", "verified/hin", "sangraha_verified"),
        ("ai4bharat/sangraha", "unverified/hin", "sangraha_unverified"),
    ],
    "it": [
        ("HPLT/HPLT2.0_cleaned", "ita_Latn", "hplt2"),
        ("HuggingFaceFW/fineweb-2", "ita_Latn", "fineweb2"),
        ("uonlp/CulturaX", "it", "culturax"),
        ("allenai/c4", "it", "c4"),
    ],
    "th": [
        ("HPLT/HPLT2.0_cleaned", "tha_Thai", "hplt2"),
        ("HuggingFaceFW/fineweb-2", "tha_Thai", "fineweb2"),
        ("uonlp/CulturaX", "th", "culturax"),
        ("allenai/c4", "th", "c4_th"),
        ("sailor2/sea-commoncrawl", "thai", "sea_cc"),
    ],
}

#: How a repository family lays out a subset's files, by a part of its name; fixed values.
LAYOUTS = {"HPLT": "{}/*", "fineweb-2": "data/{}/*", "finepdfs": "data/{}/*", "CulturaX": "{}/*", "/c4": "multilingual/c4-{}*", "sangraha": "{}/*", "sea-commoncrawl": "{}/*"}


def include_pattern(repo: str, subset: str | None) -> str | None:
    if subset is None:
        return None
    return next((layout.format(subset) for part, layout in LAYOUTS.items() if part in repo), None)


def corpora(lang: str) -> list[Corpus]:
    return [Corpus(*row) for row in CORPORA[lang]]


def fetch_commands(lang: str, base: str = "./data") -> list[str]:
    """Shell commands that fetch a language's corpora; nothing here runs them."""
    out = []
    for c in corpora(lang):
        include = f" --include '{c.include}'" if c.include else ""
        out.append(f"huggingface-cli download {c.repo}{include} --repo-type dataset --local-dir {base}/{lang}/downloads/{c.output}")
    return out
