"""Row filters over messages. Each comes as a condition on columns; ``keep`` applies one and can count what it let through."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.functions.messages import assistant_text, full_text, last_user
from quern.functions.text import WS, clean, word_count

# Patterns of what no longer works; an answer with one of them always goes.
REMOVED_API_PATTERNS = [
    r"\bApplication\.LoadLevel(Async|Additive|AdditiveAsync)?\b",
    r"\bApplication\.loadedLevel(Name)?\b",
    r"\bApplication\.LoadLevelAdditive\b",
    r"\bOnLevelWasLoaded\b",
    r"\bnew\s+WWW\b",
    r"\bWWWForm\b\s*(?=.*\bWWW\b)",
    r"\bNetworkView\b",
    r"\bNetworkServer\b",
    r"\bNetworkClient\b",
    r"\bNetworkTransport\b",
    r"\bMasterServer\b",
    r"\bNetworkMessageInfo\b",
    r"\bUnityEngine\.Networking\.NetworkManager\b",
    r"\[\s*RPC\s*\]",
    r"\bParticleEmitter\b",
    r"\bParticleAnimator\b",
    r"\bParticleRenderer\b",
    r"\bEllipsoidParticleEmitter\b",
    r"\bMeshParticleEmitter\b",
    r"\bGUIText\b",
    r"\bGUITexture\b",
    r"\bGUILayer\b",
    r"\biPhoneSettings\b",
    r"\biPhoneInput\b",
    r"\biPhoneKeyboard\b",
    r"\biPhoneUtils\b",
    r"\bApplication\.CaptureScreenshot\b",
    r"\bApplication\.RegisterLogCallback(Threaded)?\b",
    r"\bApplication\.ExternalEval\b",
    r"\bGameObject\.SetActiveRecursively\b",
    r"\bDestroyObject\b",
    r"\bEditorGUIUtility\.LookLike(Controls|Inspector)\b",
    r"\bSecurity\.PrefetchSocketPolicy\b",
]
# Patterns of what still works and is discouraged; the strict filter drops these too.
DEPRECATED_API_PATTERNS = [
    r"(?<![\w.])(?:this\.|gameObject\.)?(rigidbody|rigidbody2D|collider|collider2D|"
    r"renderer|audio|camera|light|animation|particleSystem|hingeJoint|networkView|"
    r"constantForce|guiText|guiTexture)\b\s*(?=[.\)\];,=])",
    r"\bEditorApplication\.playmodeStateChanged\b",
    r"\bComponent\.active\b",
    r"\bLight\.shadowConstantBias\b",
    r"\bTexture2D\.GetNativeTextureID\b",
]
# Fixed value: a question that is only such a phrase says nothing.
GENERIC_ONLY = (
    r"^\W*(help|help me|fix(\s+this)?|please help|how|why|what|error|it("
    r"'s| is)?\s*not\s*work(ing)?|doesn'?t\s*work|bug|broken|plz|pls|"
    r"도와\s*줘|도와주세요|도와\s*주실래요|살려\s*줘|이거\s*왜\s*안\s*돼\??|"
    r"왜\s*안\s*되(나요|죠|지)?\??|안\s*돼요\??|안\s*됨|고쳐\s*줘|고쳐\s*주세요|"
    r"에러\s*(났|나요|뜸|떠요)|버그|모르겠어요?|어떻게\s*해요?\??)\W*$"
)
# Fixed value: letters and digits that make a question more than punctuation.
HAS_ALNUM = r"[A-Za-z0-9가-힣]"
# Fixed value: marks of guessing.
SPECULATIVE = (
    r"\b(i('| a)?m not sure|i'?m not certain|i think (it )?(might|may|could)|"
    r"not 100% sure|i guess|probably (try|it'?s)|maybe (try|you)|"
    r"i don'?t (really )?know but)\b"
    r"|(아마도|아마\s*맞|확실하지\s*않|잘\s*모르겠지만|모르겠지만|"
    r"추측(으로|컨대|건대)?|장담은\s*못|확신은\s*없|아닐\s*수도|일\s*수도\s*있)"
)
#: Strings of which every match has one in lower case, free of letters that some other one equals without case (i, s).
SPECULATIVE_SIGNS = ["m not ", "nk ", "100%", "gue", "probab", "maybe", "now but", "아마", "확실하지", "모르겠", "추측", "장담은", "확신은", "수도"]
# Fixed value: a member of a type, as evidence.
API_TOKEN = r"\b[A-Z][A-Za-z0-9]+\.[A-Za-z]"
# Words of the domain.
DOMAIN_WORDS = [
    "unity", "monobehaviour", "gameobject", "transform", "rigidbody", "prefab", "scriptableobject", "coroutine", "unityengine", "urp", "hdrp", "shaderlab", "unityeditor",
]
# Columns that may hold a score or say that an answer was accepted.
SCORE_COLUMNS = ["score", "answer_score", "votes", "answer_votes"]
ACCEPTED_COLUMNS = ["accepted", "is_accepted", "answer_accepted", "accepted_answer_id", "is_answer_accepted"]
FENCE = "```"


def _java(pattern: str, flags: str = "(?Ud)") -> str:
    """A pattern with Python's meaning: Unicode classes, \\s as Python's, and . that excludes only newlines."""
    return flags + pattern.replace(r"\s", WS)


#: Strings of which every match of the patterns has one (a test holds them against the patterns). Looking for them is far cheaper than trying dozens of
#: alternatives at each character; few texts have any, and those are held against the patterns with that string alone.
REMOVED_SIGNS = ["Application.", "OnLevelWasLoaded", "WWW", "Network", "MasterServer", "RPC", "Particle", "GUI", "iPhone", "SetActiveRecursively", "DestroyObject", "Security."]
DEPRECATED_SIGNS = [
    "rigidbody", "collider", "renderer", "audio", "camera", "light", "animation", "particleSystem", "hingeJoint", "networkView", "constantForce", "guiText",
    "playmodeStateChanged", "Component.active", "shadowConstantBias", "GetNativeTextureID",
]


def _has(text: Column, signs: list[str], patterns: list[str]) -> Column:
    found = None
    for sign in signs:
        own = [p for p in patterns if sign in p.replace("\\", "")]
        one = F.contains(text, F.lit(sign)) & text.rlike(_java("|".join(own)))
        found = one if found is None else found | one
    return found


def has_removed(text: Column) -> Column:
    return _has(text, REMOVED_SIGNS, REMOVED_API_PATTERNS)


def has_deprecated(text: Column) -> Column:
    return _has(text, DEPRECATED_SIGNS, DEPRECATED_API_PATTERNS)


def outdated(text: Column, strict: bool = True) -> Column:
    """The text, put together from turns, is computed once for all that looks at it."""
    return F.transform(F.array(text), lambda t: has_removed(t) | has_deprecated(t) if strict else has_removed(t))[0]


def up_to_date(m: Column, strict: bool = True, check_user: bool = False) -> Column:
    return ~outdated(full_text(m) if check_user else assistant_text(m), strict)


def unambiguous_text(user: Column, min_chars: int = 12, min_words: int = 3) -> Column:
    u = clean(user)
    code = F.contains(u, F.lit(FENCE)) | u.rlike("[;{}]")
    enough = (F.length(u) >= min_chars) & (word_count(u) >= min_words)
    return u.rlike(HAS_ALNUM) & ~u.rlike(_java(GENERIC_ONLY, "(?iUd)")) & (enough | code)


def unambiguous(m: Column, min_chars: int = 12, min_words: int = 3) -> Column:
    return unambiguous_text(last_user(m), min_chars, min_words)


def grounded_text(answer: Column, max_markers_without_code: int = 1) -> Column:
    # the text in lower case is computed once for all signs
    signs = F.transform(F.array(F.lower(answer)), lambda t: functools.reduce(lambda a, b: a | b, [F.contains(t, F.lit(s)) for s in SPECULATIVE_SIGNS]))[0]
    markers = F.when(~signs, 0).otherwise(F.regexp_count(answer, F.lit(_java(SPECULATIVE, "(?iUd)"))))
    evidence = F.contains(answer, F.lit(FENCE)) | answer.rlike(_java(API_TOKEN))
    return (markers == 0) | (markers < max_markers_without_code) | evidence


def grounded(m: Column, max_markers_without_code: int = 1) -> Column:
    return grounded_text(assistant_text(m), max_markers_without_code)


def in_domain(text: Column, words: list[str] | None = None) -> Column:
    return text.rlike(rf"(?iU)\b({'|'.join(words or DOMAIN_WORDS)})\b")


def _accepted(c: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    if kind == "string":
        return F.coalesce(~clean(c).isin("", "0", "false", "False"), F.lit(False)) & c.isNotNull()
    return F.coalesce(c != 0, F.lit(False))


def _score(c: Column, kind: str) -> Column:
    """The integer that a score means, or null. Fractions are cut off; text counts only if it is an integer."""
    return clean(c).try_cast("bigint") if kind == "string" else c.try_cast("bigint")


def meta_ok(df: DataFrame, min_score: int = 5) -> Column:
    """Every score present is high enough (or no number), and any acceptance column, if there is one, says yes."""
    kinds = dict(df.dtypes)
    ok = F.lit(True)
    for name in SCORE_COLUMNS:
        if name in kinds:
            c = F.col(name)
            if kinds[name] == "string":
                c = F.when(clean(c).rlike(r"^[+-]?[0-9]+$"), clean(c))
            ok = ok & F.coalesce(_score(c, kinds[name]) >= min_score, F.lit(True))
    accepted = [_accepted(F.col(name), kinds[name]) for name in ACCEPTED_COLUMNS if name in kinds]
    if accepted:
        any_of = accepted[0]
        for c in accepted[1:]:
            any_of = any_of | c
        ok = ok & any_of
    return ok


def has_meta(df: DataFrame) -> bool:
    return bool(set(df.columns) & {*SCORE_COLUMNS, *ACCEPTED_COLUMNS})


def heuristic_ok(m: Column, domain_only: bool = True, min_chars: int = 120, words: list[str] | None = None) -> Column:
    long_enough = F.length(assistant_text(m)) >= min_chars
    return long_enough & in_domain(full_text(m), words) if domain_only else long_enough


def short_enough(tokens: Column, max_length: int) -> Column:
    """At most max_length tokens: longer rows are dropped, never cut."""
    return tokens <= max_length


def non_empty(m: Column) -> Column:
    return F.size(m) > 0


def keep(df: DataFrame, condition: Column, name: str | None = None) -> tuple[DataFrame, Observation | None]:
    """Rows for which the condition holds; with a name, an observation of rows ``before`` and ``after`` that costs no extra pass."""
    if name is None:
        return df.filter(condition), None
    seen = Observation(name)
    marked = df.withColumn("__kept", F.coalesce(condition, F.lit(False)))
    marked = marked.observe(seen, F.count(F.lit(1)).alias("before"), F.count_if("__kept").alias("after"))
    return marked.filter("__kept").drop("__kept"), seen
