"""Values that results depend on letter by letter.

Everything in this module is a fixed value: word lists, path rules, label
texts, answer contracts and weights. Nothing here is computed.
"""

# Words that close an issue when followed by "#<number>" (compared lower-cased).
CLOSING_KEYWORDS = [
    "close", "closes", "closed",
    "fix", "fixes", "fixed",
    "resolve", "resolves", "resolved",
]

# A lower-cased path holding any of these marks a test file.
TEST_PATH_KEYWORDS = ["test", "tests", "e2e", "testing", "tb", "tbs", "testbench"]

# File suffix (lower-cased) -> language tag.
RTL_LANGUAGES = {".v": "v", ".sv": "sv", ".svh": "sv"}

# Suffixes (lower-cased) of documentation files.
DOC_SUFFIXES = [".md", ".rst"]

# Characters that may underline a reStructuredText heading.
RST_UNDERLINES = "-=~^"

# Texts used when a prompt slot is empty.
EMPTY_TOC = "No official documents available."
EMPTY_OFFICIAL_SPEC = "None"
EMPTY_PR_CONTEXT = "No PR context available."

# Section labels of the pull request evidence, in order, with their columns.
PR_CONTEXT_SECTIONS = [
    ("PR Title", "pr_title"),
    ("PR Body", "pr_body"),
    ("Issue Title", "issue_title"),
    ("Issue Body", "issue_body"),
    ("Commit Message", "commit_message"),
]

# Boolean checks of one review, in order.
REVIEW_CHECKS = ["describes_correct_behavior", "no_patch_leakage", "sufficient_for_diagnosis"]

# Error texts of the two join failures (our own words).
MISSING_MATERIALS = "no materials for this record"
MISSING_CANDIDATE = "no candidate for this spec"

# Words a spec should use, and words it must not use.
NORMATIVE_WORDS = ["must", "shall", "should"]
BANNED_WORDS = ["incorrectly", "broken", "fixed", "bug", "patched", "repaired"]

# Allowed bug types as (level1, level2).
BUG_TYPES = [
    ("Functional Bug", "Logic Operation Bug"),
    ("Functional Bug", "State Machine Bug"),
    ("Functional Bug", "Control Flow Bug"),
    ("Functional Bug", "Data Flow Bug"),
    ("Functional Bug", "Boundary Condition Bug"),
    ("Functional Bug", "Exception Scenario Bug"),
    ("Non-functional Bug", "Configuration Bug"),
    ("Non-functional Bug", "Syntax Error"),
]

# Weights of line precision, file accuracy, recall and F1 (they add up to 0.55).
SCORE_WEIGHTS = {"line_precision": 0.20, "file_accuracy": 0.05, "recall": 0.20, "f1": 0.10}

# Repositories curated when the caller names none.
DEFAULT_REPOS = ["chipsalliance/caliptra-rtl", "lowRISC/ibex", "openhwgroup/cva6"]

# Their settings: clone address, documentation roots, source root, source suffixes.
DEFAULT_REPO_CONFIG = [
    ("lowRISC/ibex", "https://github.com/lowRISC/ibex.git", ["doc"], "rtl", [".sv", ".svh", ".v"]),
    ("chipsalliance/caliptra-rtl", "https://github.com/chipsalliance/caliptra-rtl.git", ["docs"], "src",
     [".sv", ".svh", ".v"]),
    ("openhwgroup/cva6", "https://github.com/openhwgroup/cva6.git", ["docs"], "core", [".sv", ".svh", ".v"]),
]

# Dump file names: <ORG>__<REPO>_s01_<NN>_<name>.jsonl, greedy; and the stricter candidates form.
STAGE_FILE_NAME = r"(.+)__(.+)_s01_[0-9]{2}_[a-z_]+\.jsonl\z"
CANDIDATE_FILE_NAME = r"\A([^_]+)__([^_]+)_s01_06_single_rtl_candidates\.jsonl\z"
