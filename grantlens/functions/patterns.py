"""Pattern and query sets of the statement rules, in a short notation, and their loading from files.

In a pattern a blank stands for any white space, ``_`` for one blank, ``~`` for the rest of a word and ``<`` and ``>`` for a word's edges.
"""

from __future__ import annotations

import json
import os
import re._parser as sre
from collections.abc import Iterable, Sequence

#: Java flags: no case, word characters and blanks of Unicode, a dot is all but a line feed.
FLAGS = "(?iUd)"
NO_FIGURE = r"(?!\s+(?:eq\.|equation|fig\.|figure|section|table))"


def expand(short: str) -> str:
    for a, b in ((" ", r"\s+"), ("_", " "), ("~", r"\w*"), ("<", r"\b"), (">", r"\b"), ("%NOFIG", NO_FIGURE)):
        short = short.replace(a, b)
    return short


_NOUNS = """
    accident algorithm amount analysis apparatus approach argument article assumption attitude attribute barrier behavior belief body book case category cause challenge
    character characteristic circumstance claim class coefficient color condition conference congress consequence constant constraint convention corollary criterion data
    definition demand desire device difficulty dissertation document ear effect emotion engine eq. equation estimate event evidence example expectation experiment eye face
    factor feature feeling fig. figure foot forecast form fraction function group guess guideline hand head heart hope hypothesis impact incident influence instrument issue
    kind language lecture lemma limitation logic machine measure mechanism meeting method metric mind model mood mouth nature need nose number observation obstacle
    occurrence opinion outcome paper paragraph parameter part pattern percentage personality perspective phrase position prediction presentation problem procedure process
    projection proof property proportion proposition quality quantity rate ratio reason ref. reference regulation report requirement restriction result rule scenario section
    seminar sentence sentiment set shape situation size sort soul speculation speech spirit standard standpoint state strategy structure study symposium system table
    technique temperament text texture theorem theory thesis tool type value variable view voice whole wish word workshop
""".split()
_NUMBER = r"(?:#|no\.?|number)"

POSITIVE = (
    "<acknowledg~ (?:financial|funding|support)", "<acknowledg~ (?:a|an|the) support (?:from|of)", "<fund(?:ed|er|ing|s)? (?:by|from|through)", "<support~ (?:by|from|through)%NOFIG",
    rf"<(?:award|grant)s? (?:by|from|{_NUMBER})", rf"<(?:contract|project) {_NUMBER}", "<financial~ support", "<research~ (?:fund|support)", "<this (?:research|study|work) (?:is|was) (?:funded|supported)",
    "<grateful~ (?:for|to).*(?:fund|support)", "<thank~ (?:for|to).*(?:fund|support)", "<thank~ .* for (?:her|his|their) contribution",
    r"<(?:are|been|being|is|was|were) (?:(?:also|fully|further|in part|partially|partly) )?support(?:ed|ing)? (?:[\w\s]{0,20})?(?:by|from|through)%NOFIG", rf"<(?:award|grant)s? {_NUMBER}\s*[a-z0-9]",
    "<hospitality of", "<facilities (?:of|provided by)", "<(?:fellow|scholar)ships? (?:awarded|from|funded|grant|holder|holds?|of|provided|recipient|under)", "<supported in part by",
    "<thank~ [a-z]+(?: [a-z]+)* for (?:letting|providing|support)", "<thank~ .*(?:fund|support)", "<work .*supported by", "<received .*funding", "<funding:", "<financed (?:by|in part)", "conducted_at",
    "carried_out_(?:at|within)", "the_research_of_.*_was_(?:partially_)?supported_by", "work_done_at", "this_research_used_resources_of", "by_supported", "supported_by_.*_grant",
)

_METHODS = "approach|argument|analysis|cases?|computations?|cues?|data|datum|edges?|evidence|examples?|fact|finding|hypothesis|indicator|measurements?|method|metrics?|modalities|modality|model|nodes?|observation|points?|result|simulations?|sources?|technique|tests?"
_KINDS = "biological|chemical|empirical|experimental|geometric|imaging|mathematical|measurement|mechanical|modal|numerical|physical|statistical|theoretical|thermal"
NEGATIVE = (
    "supported_by_(?:" + "|".join(x.replace(".", r"\.") for x in _NOUNS) + ")",
    "supported_by_(?:earlier|other|previous|recent|related|similar)_(?:evidence|finding|observation|research|result|study|work)", "supported_by_(?:the_)?state-of-the-art",
    f"support(?:ed|ing|s)? (?:by|from|through) (?:both|few|many|multiple|several|various) (?:{_KINDS}|{_METHODS})~",
    "support(?:ed|ing|s)? (?:by|from|through) the (?:argument|axes|axis|claim|curve|equation|fact|formula|graph|hyperplane|lemma|line|matrix|plane|proof|surface|theorem|vector)>",
    r"support(?:ed|ing|s)? \w+ (?:for|of) \w+ (?:by|from) \w+", "granted by (?:the )?(?:approval|clinical|ethics|institutional|permission|review)",
    "support(?:ing|s) (?:argument|claim|conjecture|cues|discovery|hyperplane|hypothesis)",
)

#: Words, agencies and phrases that make a paragraph worth scoring.
BROAD = (
    r"<(?:acknowledg|award|fellowship|financ|foundation|fund|grant|grate|gratitude|scholarship|sponsor|support|thank)\w*>",
    "<(?:AEI|CNES|CNPq|CONACYT|CONICET|CSIC|DFG|DOE|EPSRC|ERC|ESA|FAPESP|HFSP|JPL|JSPS|JST|KAKENHI|MCIN|MEXT|NASA|NIH|NSFC|NSF|RFBR)>", r"<in (?:the )?(?:context|framework|scope) of>",
    r"<is part of the (?:R\+D\+i|project|research)>", "<carried out (?:as|during|in|within)>", "<(?:state assignment|госзадания)>",
)

#: Strong patterns of the rescue.
STRONG = (
    "<this (?:paper|project|research|study|work) (?:has been|is|was) (?:financed|funded|supported)", rf"<grant {_NUMBER}\s*[a-z0-9-]+", rf"<award {_NUMBER}\s*[a-z0-9-]+", "<funded by>", "<financed by>",
    "<supported in part by>", r"<under (?:award|contract|grant) (?:no\.?|number)?\s*[a-z0-9]", "<received (?:financial )?(?:funding|support) from", "<acknowledg~ (?:the )?(?:financial )?support (?:from|of)",
    "<this material is based (?:on|upon) work supported", "this_research_used_resources_of",
)

#: (name, weight, patterns) of the confidence score.
MARKERS = (
    ("grant_number", 30, (rf"<grant (?:agreement )?{_NUMBER}\s*[a-z0-9-]+", rf"<(?:award|contract|project) {_NUMBER}\s*[a-z0-9-]+", r"<[a-z]{1,4}\d{2}[-_]?[a-z]{2}\d{5,7}>", r"<[a-z]{2,4}[-_]?\d{6,8}>")),
    ("this_work_structure", 30, (STRONG[0], STRONG[9], "<research reported (?:in this (?:paper|publication) )?was supported")),
    ("financial_verbs", 20, (STRONG[3], STRONG[4], STRONG[7], "<supported (?:in part )?by>", "<acknowledg~ (?:the )?(?:financial )?support")),
    ("organization_structure", 20, ("<foundation (?:for|of) [a-z]", "<ministry of [a-z]", "<(?:national|research) council>", "<(?:national|research) (?:science )?foundation>")),
    ("under_grant", 15, ("<under (?:award|contract|grant|project)>", "<under the (?:aegis|auspices) of>")),
    ("partial_funding", 10, ("<part(?:ial)?ly (?:funded|supported) by", "<supported in part by", "<in part by (?:a )?grant")),
    ("author_specific", 10, (r"<[a-z]\.\s*[a-z]{2,} (?:acknowledges|is|was) (?:funded|supported)", "<[a-z]{2,} gratefully acknowledges", "<[a-z]{2,} (?:is|was) (?:grateful|thankful) (?:for|to)", "<the (?:first|second|third) author (?:is|was) supported")),
    ("citation_reference", -40, (r"^\s*\[\d+\]", r"^\s*\d+\. [a-z]{2,}", r"(?:[a-z]\.\s*)+[a-z]+, [a-z]\.\s*[a-z]+")),
    ("technical_context", -35, (
        "supported by (?:analysis|data|evidence|findings?|observations?|results?)", r"supported by (?:eq\.|equation|fig\.|figure|lemma|section|table|theorem)", "supported by (?:earlier|previous|prior|recent|related) (?:research|study|work)",
        "supported by (?:our|the|these|this) (?:findings?|observations?|results?)", "<(?:decision|emotional|technical) support>", "<support (?:inference|system|vector)>", "<(?:argument|claim|hypothesis) is supported by",
    )),
    ("author_bio", -30, (
        r"<received (?:her|his|the) (?:b\.?s\.?|m\.?s\.?|ph\.?d)", "<is an? (?:engineer|professor|researcher|scientist|student)", "<joined (?:a|the) (?:department|faculty|group|team)",
        "<was (?:a )?recipient of (?:the )?(?:best|distinguished)", "<currently work(?:ing|s) (?:at|for|on)",
    )),
)

#: Retrieval queries in their order, which breaks ties; a lexical encoder does not mind the order of words.
QUERIES = {
    "funding_statement": "acknowledgement assistance financial funding grant statement support",
    "grant_acknowledgment": "award code funding grant identifier number project reference",
    "financial_support": "assistance by financial funding monetary research sponsored support",
    "acknowledgements": "acknowledgements funding gratitude section support thanks",
    "author_acknowledgements": "acknowledgements author contributor declaration funding thanks",
    "research_funding": "award by fellowship funded grant research scholarship supported",
    "project_support": "agreement contract cooperative funded grant project supported",
    "institutional_support": "departmental funding funding grant institutional internal support university",
    "government_funding": "agency council federal funded government national provincial research state",
    "public_funding": "funded funding government grant institute ministry national public taxpayer",
    "foundation_support": "charity donation endowment foundation fund philanthropic trust",
    "nonprofit_funding": "charitable donation foundation fund nonprofit organization trust",
    "research_grant": "RG award code grant identifier number reference research",
    "fellowship_award": "award doctoral fellowship postdoctoral scholarship stipend",
    "equipment_grant": "equipment facility funding grant infrastructure instrumentation support",
    "travel_grant": "attendance conference funding grant meeting support travel",
    "contract_funding": "agreement agreement contract contract identifier number research service",
    "cooperative_agreement": "agreement collaboration contract cooperative funding joint partnership",
    "funding_disclosure": "competing declaration disclosure disclosure financial funding interests",
    "conflict_interest": "conflict declaration disclosure financial interest interest of statement",
    "acknowledge_support": "acknowledge appreciation assistance grateful recognize support thanks",
    "thank_funders": "acknowledge appreciate contribution funders gratitude support thank",
    "grant_identifier": "award code grant identifier number number number number project reference",
    "funding_reference": "award code funding grant identifier identifier project reference",
    "multi_year_grant": "continuing funding grant grant long-term multi-year support sustained",
    "seed_funding": "exploratory funding funding grant grant initial pilot seed startup support",
    "block_grant": "award block core funding funds grant institutional unrestricted",
    "targeted_funding": "designated earmarked funding funds purpose specific support targeted",
    "matching_funds": "contribution cost-share funding funds in-kind leveraged matching",
    "hospitality": "acknowledgement by facilities hospitality hosting institution provided",
    "resources": "access computing equipment facilities resources support technical",
    "scholarship_fellowship": "doctoral fellowship funding postdoctoral scholarship stipend support",
}


def either(patterns: Sequence[str]) -> str:
    """One expression for all patterns, for any engine."""
    return "(?:" + "|".join(f"(?:{expand(p)})" for p in patterns) + ")"


def _best(found: Iterable[frozenset[str] | None]) -> frozenset[str] | None:
    """Of sets of words, each of which has one that must occur, the one whose shortest word is longest."""
    return max((f for f in found if f), key=lambda f: (min(map(len, f)), -len(f)), default=None)


def _required(parsed) -> frozenset[str] | None:
    found, run = [], ""
    for op, arg in [*parsed, (None, None)]:
        if op is sre.LITERAL:
            run += chr(arg).lower()
            continue
        found.append(frozenset([run]) if run else None)
        run = ""
        if op is sre.SUBPATTERN:
            found.append(_required(arg[3]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            found.append(_required(arg[2]))
        elif op is sre.BRANCH:
            each = [_required(a) for a in arg[1]]
            found.append(frozenset().union(*each) if all(each) else None)
    return _best(found)


def required(pattern: str, least: int = 3) -> frozenset[str] | None:
    """Lower-case words of ``least`` letters or more, one of which is in every text that an expanded pattern matches; None where there are none."""
    got = _required(sre.parse(expand(pattern)))
    return got if got and min(map(len, got)) >= least else None


def load(path: str | None, default: dict, kind: str) -> dict:
    """A set of queries or patterns: ``default``, or a JSON file ``path``, or ``<path>/<kind>.json`` of a folder; an error where it is missing or no object."""
    if path is None:
        return default
    at = os.path.join(path, f"{kind}.json") if os.path.isdir(path) else path
    with open(at, encoding="utf-8") as f:
        got = json.load(f)
    if not isinstance(got, dict):
        raise ValueError(f"{at} holds no object")
    return got
