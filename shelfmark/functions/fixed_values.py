"""Lookup tables and word lists that results depend on."""

from __future__ import annotations

# File extension (exact case) -> language.
EXTENSION_LANGUAGE: dict[str, str] = {
    ".py": "Python",
    ".js": "JavaScript",
    ".ts": "TypeScript",
    ".jsx": "JavaScript",
    ".tsx": "TypeScript",
    ".java": "Java",
    ".kt": "Kotlin",
    ".kts": "Kotlin",
    ".cs": "C#",
    ".cpp": "C++",
    ".cc": "C++",
    ".cxx": "C++",
    ".c": "C",
    ".h": "C",
    ".hpp": "C++",
    ".go": "Go",
    ".rs": "Rust",
    ".rb": "Ruby",
    ".php": "PHP",
    ".swift": "Swift",
    ".scala": "Scala",
    ".r": "R",
    ".R": "R",
    ".m": "Objective-C",
    ".sh": "Shell",
    ".bash": "Shell",
    ".zsh": "Shell",
    ".ps1": "PowerShell",
    ".lua": "Lua",
    ".ex": "Elixir",
    ".exs": "Elixir",
    ".erl": "Erlang",
    ".hs": "Haskell",
    ".clj": "Clojure",
    ".dart": "Dart",
    ".vim": "Vim script",
    ".tf": "HCL",
    ".ml": "OCaml",
    ".mli": "OCaml",
}

# Languages whose definitions are extracted.
DEFINITION_LANGUAGES: tuple[str, ...] = ("Python", "JavaScript", "TypeScript")

# The English stop words of PostgreSQL's text search.
ENGLISH_STOP_WORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now
    """.split()
)

# Words the English Snowball stemmer maps directly.
STEM_EXCEPTIONS: dict[str, str] = {
    "skis": "ski",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "idly": "idl",
    "gently": "gentl",
    "ugly": "ugli",
    "early": "earli",
    "only": "onli",
    "singly": "singl",
    "sky": "sky",
    "news": "news",
    "howe": "howe",
    "atlas": "atlas",
    "cosmos": "cosmos",
    "bias": "bias",
    "andes": "andes",
}

# Words the stemmer leaves alone once a plural s is gone.
STEM_STOPS_AFTER_PLURAL: tuple[str, ...] = (
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
)

# Suffix replacements of the English Snowball stemmer, step 2.
STEM_STEP_2: dict[str, str] = {
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "abli": "able",
    "entli": "ent",
    "izer": "ize",
    "ization": "ize",
    "ational": "ate",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "aliti": "al",
    "alli": "al",
    "fulness": "ful",
    "ousli": "ous",
    "ousness": "ous",
    "iveness": "ive",
    "iviti": "ive",
    "biliti": "ble",
    "bli": "ble",
    "ogi": "og",
    "fulli": "ful",
    "lessli": "less",
    "li": "",
}

# Suffix replacements, step 3.
STEM_STEP_3: dict[str, str] = {
    "tional": "tion",
    "ational": "ate",
    "alize": "al",
    "icate": "ic",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
    "ative": "",
}

# Suffixes removed in step 4.
STEM_STEP_4: tuple[str, ...] = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)
