"""Look-up data.

The values below are fixed: results depend on their exact spelling.  All of
them are small and do not grow with the data, so they are used as literals.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- fixed values: article types --------------------------------------------

APS_DOCTYPES = {
    "article": "article",
    "erratum": "erratum",
    "editorial": "editorial",
    "retraction": "retraction",
    "essay": "other",
    "comment": "other",
    "letter-to-editor": "other",
    "rapid": "other",
    "brief": "other",
    "reply": "other",
    "announcement": "other",
    "nobel": "other",
}

JATS_DOCTYPES = {
    "research-article": "article",
    "corrected-article": "article",
    "original-article": "article",
    "correction": "corrigendum",
    "addendum": "addendum",
    "editorial": "editorial",
}

ELSEVIER_DOCTYPES = {
    "article": "article",
    "sco": "article",
    "fla": "article",
    "abs": "article",
    "rev": "article",
    "add": "addendum",
    "edb": "editorial",
    "edi": "editorial",
    "err": "erratum",
    "ret": "retraction",
    "rem": "retraction",
    "adv": "other",
    "ann": "other",
    "brv": "other",
    "cal": "other",
    "chp": "other",
    "cnf": "other",
    "con": "other",
    "cop": "other",
    "cor": "other",
    "crp": "other",
    "dis": "other",
    "dup": "other",
    "exm": "other",
    "ind": "other",
    "lit": "other",
    "mis": "other",
    "nws": "other",
    "ocn": "other",
    "pgl": "other",
    "pnt": "other",
    "prp": "other",
    "prv": "other",
    "pub": "other",
    "req": "other",
    "ssu": "other",
}

SPRINGER_DOCTYPES = {
    "OriginalPaper": "article",
    "ReviewPaper": "review",
    "BriefCommunication": "article",
    "EditorialNotes": "editorial",
    "BookReview": "review",
    "ContinuingEducation": "other",
    "Interview": "other",
    "Letter": "other",
    "Erratum": "erratum",
    "Legacy": "other",
    "Abstract": "other",
    "Report": "other",
    "Announcement": "other",
    "News": "other",
    "Events": "other",
    "Acknowledgments": "other",
    "MediaReport": "other",
    "BibliographicalNote": "other",
    "ProductNotes": "other",
    "Unknown": "other",
}

# --- fixed values: journals --------------------------------------------------

ELSEVIER_JOURNALS = {
    "PLB": "Physics Letters B",
    "NUPHB": "Nuclear Physics B",
}

JOURNAL_FULL_NAMES = {
    "PTEP": "Progress of Theoretical and Experimental Physics",
    "New J. Phys.": "New Journal of Physics",
    "JCAP": "Journal of Cosmology and Astroparticle Physics",
    "EPJC": "European Physical Journal C",
    "Chinese Phys. C": "Chinese Physics C",
    "JHEP": "Journal of High Energy Physics",
    "Physics letters B": "Physics Letters B",
    "Phys. Rev. C": "Physical Review C",
    "Phys. Rev. D": "Physical Review D",
    "Phys. Rev. Lett.": "Physical Review Letters",
}

SPRINGER_FOLDERS = ("JHEP", "EPJC")

# --- fixed values: licences --------------------------------------------------

LICENSES = {
    "creativecommons.org/licenses/by/": "CC-BY-",
    "creativecommons.org/licenses/by-nc-sa/": "CC-BY-NC-SA-",
    "arxiv.org/licenses/nonexclusive-distrib/": "arXiv-",
}

LICENSE_TEXTS = {
    "Creative Commons Attribution-NonCommercial-ShareAlike":
        "https://creativecommons.org/licenses/by-nc-sa/3.0",
    "Creative Commons Attribution 2.0": "http://creativecommons.org/licenses/by/2.0/",
    "Creative Commons Attribution 3.0": "http://creativecommons.org/licenses/by/3.0/",
    "Creative Commons Attribution 4.0": "http://creativecommons.org/licenses/by/4.0/",
}

# --- fixed values: languages -------------------------------------------------

LANGUAGES = {
    "fr": "French",
    "ru": "Russian",
    "ge": "German",
    "es": "Spanish",
    "la": "Latin",
    "it": "Italian",
    "ja": "Japanese",
    "pt": "Portuguese",
    "cn": "Chinese",
    "ro": "Romanian",
    "pl": "Polish",
    "nl": "Dutch",
    "cs": "Czech",
    "id": "Indonesian",
    "no": "Norwegian",
    "sv": "Swedish",
    "he": "Hebrew",
    "hu": "Hungarian",
    "ko": "Korean",
    "fre": "French",
    "rus": "Russian",
    "ger": "German",
    "esp": "Spanish",
    "lat": "Latin",
    "ita": "Italian",
    "jap": "Japanese",
    "por": "Portuguese",
    "chi": "Chinese",
    "rom": "Romanian",
    "pol": "Polish",
    "dut": "Dutch",
    "cze": "Czech",
    "ind": "Indonesian",
    "nor": "Norwegian",
    "swe": "Swedish",
    "heb": "Hebrew",
    "hun": "Hungarian",
    "kor": "Korean",
}

# --- fixed values: words -----------------------------------------------------

COMMON_ACRONYMS = (
    "LHC",
    "CFT",
    "QCD",
    "QED",
    "QFT",
    "ABJM",
    "NLO",
    "LO",
    "NNLO",
    "IIB",
    "IIA",
    "MSSM",
    "NMSSM",
    "SYM",
    "WIMP",
    "ATLAS",
    "CMS",
    "ALICE",
    "RHIC",
    "DESY",
    "HERA",
    "CDF",
    "D0",
    "BELLE",
    "BABAR",
    "BFKL",
    "DGLAP",
    "SUSY",
    "QM",
    "UV",
    "IR",
    "BRST",
    "PET",
    "GPS",
    "NMR",
    "XXZ",
    "CMB",
    "LISA",
    "CPT",
    "KEK",
    "TRIUMF",
    "PHENIX",
    "VLBI",
    "NGC",
    "SNR",
    "HESS",
    "AKARI",
    "GALEX",
    "ESO",
    "J-PARC",
    "CERN",
    "XFEL",
    "FAIUR",
    "ILC",
    "CLIC",
    "SPS",
    "BNL",
    "CEBAF",
    "SRF",
    "LINAC",
    "HERMES",
    "ZEUS",
    "H1",
    "GRB",
)

MATHML_ELEMENTS = (
    "annotation",
    "annotation-xml",
    "maction",
    "math",
    "merror",
    "mfenced",
    "mfrac",
    "mi",
    "mmultiscripts",
    "mn",
    "mo",
    "mover",
    "mpadded",
    "mphantom",
    "mprescripts",
    "mroot",
    "mrow",
    "mspace",
    "msqrt",
    "mstyle",
    "msub",
    "msubsup",
    "msup",
    "mtable",
    "mtd",
    "mtext",
    "mtr",
    "munder",
    "munderover",
    "none",
    "semantics",
)

CONFERENCE_WORDS = (
    "colloquium",
    "colloquiums",
    "conf",
    "conference",
    "conferences",
    "contrib",
    "contributed",
    "contribution",
    "contributions",
    "forum",
    "lecture",
    "lectures",
    "meeting",
    "meetings",
    "pres",
    "presented",
    "proc",
    "proceeding",
    "proceedings",
    "rencontre",
    "rencontres",
    "school",
    "schools",
    "seminar",
    "seminars",
    "symp",
    "symposium",
    "symposiums",
    "talk",
    "talks",
    "workshop",
    "workshops",
)

THESIS_WORDS = (
    "diploma",
    "diplomarbeit",
    "diplome",
    "dissertation",
    "doctoraal",
    "doctoral",
    "doctorat",
    "doctorate",
    "doktorarbeit",
    "dottorato",
    "habilitationsschrift",
    "hochschule",
    "inauguraldissertation",
    "memoire",
    "phd",
    "proefschrift",
    "schlussbericht",
    "staatsexamensarbeit",
    "tesi",
    "thesis",
    "travail",
)

# --- use in plans ------------------------------------------------------------


def _quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def as_map(mapping: Mapping[str, str]) -> Column:
    """A literal map, folded into the plan."""
    pairs = ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in mapping.items())
    return F.expr(f"map({pairs})")


def translate(c: Column, mapping: Mapping[str, str], default: Column | str) -> Column:
    """Value of the code in a fixed mapping, or the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(as_map(mapping), c), fallback)


def as_table(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """A fixed mapping as a two-column table, of a size that Spark can tell."""
    return spark.range(1).select(F.explode(as_map(mapping)).alias("key", "value"))
