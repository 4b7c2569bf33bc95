"""A grammar of refusals: word classes in several languages, and the orders in which they decline."""

from __future__ import annotations

import re

#: The classes of words that the productions are made of. The agent is in the singular: "we cannot divide by zero" declines nothing.
CLASSES = {
    "agent": "i ich je mi yo eu io я ik",
    "be": "be am are is was being bin sind suis sommes",
    "will": "can will must may could would should do shall",
    "cannot": "cannot unable incapable",
    "able": "able allowed permitted",
    "not": "not never nicht keine keinen ne no non não не niet",
    "modal": "kann können möchte möchten will wollen darf dürfen werde werden kan mag zal",
    "own": "peux puis souhaite veux suis vais répondrai saurais donnerai traiterai puedo podré podemos voy quiero deseo debo"
    " responderé resolveré posso potrò voglio riesco intendo consigo vou quero могу буду хочу смогу",
    "decline": "refuse decline verweigere verweigern ablehnen lehne décline refuser décliner negarme rechazar declinar rifiutare declinare recusar weiger weigeren отказаться",
    "declining": "rechazo declino rifiuto recuso отказываюсь",
    "must": "must have muss müsste dois devons debo devo moet вынужден",
    "rules": "guidelines guideline policy policies rules richtlinien règles normas regole",
    "act": "help answer assist respond reply solve comply provide",
    "forbid": "keep prevent forbid stop prohibit verbieten interdisent prohíben vietano",
}
#: The productions: classes and words in order, ``_`` for any word, ``?`` after what may be absent, ``*`` for any number of words, ``^`` and ``$`` for the ends.
PRODUCTIONS = (
    "agent _? cannot", "agent _? will not", "agent be _? cannot", "agent be _? not able", "^ _? cannot to", "we _? cannot act",
    "agent _? decline", "must to? decline", "agent must to? decline", "declining",
    "agent modal * not", "modal agent * not", "agent must * decline", "must agent * decline",
    "not me? own", "not agent own", "agent not own", "mi rifiuto", "me niego", "eu me recuso", "me recuso",
    "rules _? forbid", "rules _? do not allow", "no answer will be given", "no answer can be given",
    "fall outside of? what agent", "falls outside of? what agent", "agent will need to look elsewhere", "you will need to look elsewhere",
    "as an ai * cannot", "as an ai * not", "as an assistant * cannot", "as an assistant * not",
    "impossible de vous? t? aider", "impossible de vous? t? répondre", "impossible de vous? t? traiter", "no me es posible", "non mi è possibile", "não me é possível",
)
#: The same in Chinese, which has no spaces.
_HAN = re.compile(r"我(?:无法|不能|不会|不便|拒绝|没有办法|没法)|恕(?:我)?(?:难|不能|无法)|不予(?:回答|解答)|无法(?:回答|解答|帮助|提供)|不能(?:回答|解答)")
#: Contracted forms, taken apart.
_CONTRACTED = tuple((re.compile(p), by) for p, by in ((r"\bcan(?:'t|t| not)\b", "cannot"), (r"\bwon't\b", "will not"), (r"n't\b", " not"), (r"'m\b", " am"), (r"'re\b", " are"), (r"\b([dnjt])'", r"\1e ")))
_WORD = re.compile(r"[^\W\d_]+")


def _compiled(production: str) -> str:
    out = ""
    for symbol in production.split():
        bare, mark = (symbol[:-1], "?") if len(symbol) > 1 and symbol[-1] == "?" else (symbol, "")
        if bare == "^":
            out += "^ "
        elif bare == "*":
            out += "(?:[^ ]+ )*?"
        else:
            words = "[^ ]+" if bare == "_" else "|".join(map(re.escape, CLASSES.get(bare, bare).split()))
            out += f"(?:(?:{words}) ){mark}"
    return out if out[0] == "^" else " " + out


_GRAMMAR = re.compile("|".join(map(_compiled, PRODUCTIONS)))
#: No production without one of these.
_NEEDED = frozenset(" ".join(CLASSES[c] for c in ("cannot", "not", "decline", "declining", "forbid")).split()) | {"outside", "elsewhere", "impossible", "rifiuto", "niego", "recuso"}


def declines(sentence: str) -> bool:
    """Whether a sentence has the form of a refusal."""
    if _HAN.search(sentence):
        return True
    low = sentence.casefold().replace("’", "'")
    if "'" in low or "can not" in low or "cant" in low:
        for pattern, by in _CONTRACTED:
            low = pattern.sub(by, low)
    words = _WORD.findall(low)
    return not _NEEDED.isdisjoint(words) and _GRAMMAR.search(f" {' '.join(words)} ") is not None
