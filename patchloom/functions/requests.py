"""Request texts for the external model: one template per kind, filled from columns.

The wording is ours; slots and answer contracts are what the parsers expect.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions.text import or_empty, strip

ISSUE_REFS = """List every issue of the hosting site that the pull request text below refers to,
however it is phrased. Answer with one JSON object and nothing else. Its only
key is "issues", an array of the issue numbers as digit strings without "#".

Text:
{text}
"""

DOC_SELECTION = """Pick the documents that help to describe what one hardware module must do.

Repository: {repo}
Source file: {rtl_file}

Source:
{fixed_rtl_code}

Documents on offer:
{doc_toc}

Answer with one JSON object and nothing else: "selected_doc_paths" is an array of
paths from the list above (empty when none helps), "reason" is one sentence.
"""

SPEC = """Describe the required behaviour of one hardware module in Markdown.

Repository: {repo}
Language: {lang}
Source files: {rtl_files}

Source:
{rtl_code}

Documents:
{official_spec}

Say what the module must, shall or should do under which conditions, so that an
engineer new to the project can follow. Leave out how it is built: no signal or
variable names, no line numbers, no tests. Do not hint at defects or repairs;
avoid these words: {banned_words}.
"""

REVIEW = """Judge a generated behaviour description against the change it belongs to.

Evidence:
{pr_contexts}

Change:
{fix_patch}

Source:
{rtl_code}

Description:
{generated_spec}

Checks, each true or false:
- describes_correct_behavior: it states required behaviour normatively and hints at no defect
- no_patch_leakage: no name, expression or line number of the change appears in it
- sufficient_for_diagnosis: at least one statement covers what the change touches

Answer with one JSON object and nothing else: "passed" (boolean), "checks" (object
with the three names above) and "reasoning" (one sentence).
"""

HUNK_SHORTLIST = """Sort the hunks of a repair into those that may hold the cause of the defect and those that do not.

Repository: {repo}
Language: {lang}

Evidence:
{pr_contexts}

Source before the change:
{rtl_code}

Hunks, each under its name:
{hunks}

Keep every hunk that may hold the cause; leave out only what is plainly layout, comment,
renaming, clean-up, test or adaptation. Answer with one JSON object and nothing else:
"candidate_root_cause_hunks" and "filtered_non_root_cause_hunks" are arrays of objects
with "hunk_ids" (array of names from above) and "reason" (one sentence).
"""

ANNOTATION = """Describe the defect behind each confirmed hunk of a repair.

Repository: {repo}
Language: {lang}

Required behaviour:
{spec}

Confirmed hunks:
{root_cause_hunks}

Source before the change:
{rtl_code}

Evidence:
{pr_contexts}

Allowed types, as level1 / level2:
{bug_types}

Answer with one JSON object and nothing else: "bug_info" is an array that holds one
array with an object per hunk: "hunk_id" as given, "bug_type" (object of "level1" and
"level2", spelt as above), "bug_desc" (when it shows, how, and where the cause lies) and
"fix_hint" (the direction of a repair, without code of the change).
"""


def fill(template: str, **slots: Column) -> Column:
    """Put columns into the ``{name}`` slots of a template; a null slot reads as empty."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [or_empty(slots[p]) if i % 2 else F.lit(p) for i, p in enumerate(pieces)]
    return F.concat(*parts)


def pr_contexts(columns: dict[str, Column]) -> Column:
    """Labelled evidence sections; blank ones are left out, a fixed sentence stands for none."""
    sections = []
    for label, name in fixed.PR_CONTEXT_SECTIONS:
        value = strip(or_empty(columns[name]))
        sections.append(F.when(value != "", F.concat(F.lit(f"#### {label}\n"), value)))
    joined = F.concat_ws("\n\n", *sections)
    return F.when(joined == "", fixed.EMPTY_PR_CONTEXT).otherwise(joined)
