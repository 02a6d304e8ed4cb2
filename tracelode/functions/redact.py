"""Secret and personal-data redaction as native column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "[REDACTED_"


@dataclass(frozen=True)
class Rule:
    """``hints``: lower-case literals; a text without any of them cannot match ``pattern``. ``needs``: others of the same kind.

    A substring test is far cheaper than a scan with the pattern, so it comes first. ``needs`` are few and seldom in prose, and many
    rules share them: most texts are done with after these.
    """

    name: str
    pattern: str
    replacement: str
    hints: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}"

    def matches(self, text: Column, lowered: Column) -> Column:
        return _holds_any(lowered, self.needs, _holds_any(lowered, self.hints, text.rlike(self.regex)))


def _holds_any(lowered: Column, literals: tuple[str, ...], then: Column) -> Column:
    """``then`` for texts that hold one of the literals; without literals, for all."""
    return _any([F.contains(lowered, F.lit(x)) for x in literals]) & then if literals else then


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests)


#: Every assignment, header and address holds one of these.
_ASSIGNS = (":", "=")

# What a credential is called, by itself or at the end of a longer name, and what may follow the name.
_KEY = (
    r"(?:api[_-]?key|access[_-]?key|secret|password|passwd|passphrase|auth_token|token)"
    r"(?:[_-]?(?:access|key|id|value|token|string|base64|prod|test)){0,3}"
)
# A quoted value, with escaped quotes inside; quoted inside JSON text, where every quote and backslash is escaped once more; or cut off by
# the end of the text. Possessive: a long value is walked through once, without a stack.
_QUOTED = "(?:" + "|".join(
    (
        r"\\\"(?!\\\")[^\"\\]*+(?:\\\\(?:\\.|[^\\])[^\"\\]*+)*+\\\"",
        r"\\'(?!\\')[^'\\]*+(?:\\\\(?:\\.|[^\\])[^'\\]*+)*+\\'",
        r"\"(?!\")[^\"\\]*+(?:\\[\s\S][^\"\\]*+)*+\"",
        r"'(?!')[^'\\]*+(?:\\[\s\S][^'\\]*+)*+'",
        r"\\?['\"][^\s'\"\\]{3,}\z",
    )
) + ")"
# Borders of a word in ASCII; what a letter is elsewhere does not matter.
_BEGIN, _END = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
_BARE = r"[^\s'\"\\,;&(){}\[\]<>]"

# Rule order, tags and what they stand for (all matched without regard to case). A credential may be
# quoted either way, escaped inside JSON, a JSON member, or bare if it holds a digit.
CORE_RULES: tuple[Rule, ...] = (
    Rule("aws_key", r"AKIA[0-9A-Z]{16}", "[REDACTED_AWS_KEY]", ("akia",)),
    Rule("aws_temp_key", r"ASIA[0-9A-Z]{16}", "[REDACTED_AWS_TEMP_KEY]", ("asia",)),
    Rule(
        "jwt",
        r"eyJ[a-zA-Z0-9_-]+\.eyJ[a-zA-Z0-9_-]+\.[a-zA-Z0-9_-]+",
        "[REDACTED_JWT_TOKEN]",
        ("eyj",),
    ),
    Rule(
        "credential",
        rf"({_KEY}\\?['\"]?\s*[:=]\s*)(?:{_QUOTED}|{_BARE}*[0-9]{_BARE}*)",
        "$1[REDACTED_CREDENTIAL]",
        ("key", "secret", "pass", "token"),
        _ASSIGNS,
    ),
    Rule("url_credentials", r"https?://[^\s:/@]+:[^\s@/]+@\S+", "[REDACTED_URL_CREDS]", ("://",), _ASSIGNS),
    Rule(
        "private_key",
        r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----[\s\S]*?"
        r"(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----|\z)",
        "[REDACTED_PRIVATE_KEY]",
        ("-----begin",),
    ),
)

# Spellings that the list above lets pass: assignments without a digit, authorization headers, command lines.
HEADER_RULES: tuple[Rule, ...] = (
    Rule(
        "assigned_credential",
        rf"({_KEY}=){_BARE}{{3,}}",
        "$1[REDACTED_CREDENTIAL]",
        ("key", "secret", "pass", "token"),
        _ASSIGNS,
    ),
    Rule(
        "connection_password",
        rf"({_BEGIN}pwd\s*=\s*)(?:{_QUOTED}|[A-Za-z0-9!@#%^*_+][^\s'\"\\,;&(){{}}\[\]<>/]{{2,}})",
        "$1[REDACTED_CREDENTIAL]",
        ("pwd",),
        _ASSIGNS,
    ),
    Rule(
        "password_line",
        rf"((?:password|passwd|passphrase)[ \t]*:[ \t]+){_BARE}{{8,}}([ \t]*(?:[\r\n]|\z))",
        "$1[REDACTED_CREDENTIAL]$2",
        ("pass",),
        _ASSIGNS,
    ),
    Rule(
        "auth_header",
        r"(authorization\\?['\"]?\s*[:=]\s*\\?['\"]?(?:bearer|basic|token)\s+)[A-Za-z0-9._~+/=-]+",
        "$1[REDACTED_AUTHORIZATION]",
        ("authorization",),
        _ASSIGNS,
    ),
    Rule("bearer_token", rf"({_BEGIN}bearer\s+)[A-Za-z0-9._~+/-]{{20,}}=*", "$1[REDACTED_BEARER]", ("bearer",)),
    Rule(
        "command_line_user",
        rf"({_BEGIN}curl{_END}[^\r\n]{{0,200}}?[ \t](?:-u|--user)[ \t=]*\\?['\"]?[^\s:'\"\\]+:)[^\s'\"\\\[]+",
        "$1[REDACTED_CREDENTIAL]",
        ("curl",),
        _ASSIGNS,
    ),
)

# What the tokens of well-known services begin with.
PROVIDER_RULES: tuple[Rule, ...] = (
    Rule(
        "provider_token",
        _BEGIN + r"(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{20,}|xox[abeprs]-[A-Za-z0-9-]{10,}"
        r"|sk-(?:[a-z]{2,8}-)?[A-Za-z0-9]{20,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{30,}|hf_[A-Za-z0-9]{30,})",
        "[REDACTED_PROVIDER_TOKEN]",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xox", "sk-", "k_live_", "k_test_", "aiza", "npm_", "hf_"),
        ("_", "glpat-", "xox", "sk-", "aiza"),
    ),
)

# Cloud storage keys and connection strings: named in the design, absent from its rule list.
CLOUD_RULES: tuple[Rule, ...] = (
    Rule(
        "storage_account_key",
        r"((?:Account|SharedAccess)Key\s*=\s*)[A-Za-z0-9+/]{20,}={0,2}",
        "$1[REDACTED_STORAGE_KEY]",
        ("accountkey", "sharedaccesskey"),
        _ASSIGNS,
    ),
    Rule(
        "connection_string",
        r"((?:jdbc|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://)[^\s:/@]+:[^\s@/]+@",
        "$1[REDACTED_CONNECTION]@",
        ("://",),
        _ASSIGNS,
    ),
)

SECRET_RULES = CLOUD_RULES[:1] + CORE_RULES + HEADER_RULES + PROVIDER_RULES + CLOUD_RULES[1:]


PERSONAL_RULES: tuple[Rule, ...] = (
    Rule(
        "email",
        r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9-]+(?:\.[a-zA-Z0-9-]+)*\.[a-zA-Z]{2,}",
        "[REDACTED_EMAIL]",
        ("@",),
    ),
    Rule("ipv4", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "[REDACTED_IP]"),
    Rule("card_number", r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b", "[REDACTED_CARD]"),
)


def _column(text: str | Column) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _with_lowered(text: Column, test: Callable[[Column], Column]) -> Column:
    """``test(lower(text))`` with the lowered text computed once, in any operator."""
    return F.coalesce(F.exists(F.array(F.lower(text)), test), F.lit(False))


def has_match(text: str | Column, rules: tuple[Rule, ...] = SECRET_RULES) -> Column:
    """Does any rule match? Literals that several rules ask for are looked for once."""
    col = _column(text)
    asked: dict[tuple[str, ...], dict[tuple[str, ...], list[Rule]]] = {}
    for rule in rules:
        asked.setdefault(rule.needs, {}).setdefault(rule.hints, []).append(rule)

    def test(low: Column) -> Column:
        found = []
        for needs, by_hints in asked.items():
            matched = [_holds_any(low, hints, _any([col.rlike(r.regex) for r in same])) for hints, same in by_hints.items()]
            found.append(_holds_any(low, needs, _any(matched)))
        return _any(found)

    return _with_lowered(col, test)


def redact(text: str | Column, rules: tuple[Rule, ...] = SECRET_RULES) -> Column:
    """Fold the rules over the text in order. NULL and '' pass through.

    A text that no rule matches is returned as it is, without the replacements.
    """
    col = _column(text)
    folded = reduce(lambda out, rule: F.regexp_replace(out, rule.regex, rule.replacement), rules, col)
    return F.when(has_match(col, rules), folded).otherwise(col)


def will_be_flagged(text: str | Column, rules: tuple[Rule, ...] = SECRET_RULES) -> Column:
    """The same as ``is_flagged(redact(text))``, from the raw text.

    The first rule that matches sees the raw text and adds a tag, and every later
    replacement adds a tag itself. A filter on this needs no replacement at all.
    """
    return has_match(text, rules) | is_flagged(text)


def matched_rules(text: str | Column, rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that match, in order."""
    col = _column(text)

    def names(low: Column) -> Column:
        return F.array_compact(F.array(*[F.when(rule.matches(col, low), F.lit(rule.name)) for rule in rules]))

    return F.transform(F.array(F.lower(col)), names)[0]


def hits(text: str | Column, rules: tuple[Rule, ...]) -> Column:
    """Number of matches per rule, as an array in rule order."""
    col = _column(text)

    def counts(low: Column) -> Column:
        return F.array(
            *[F.when(rule.matches(col, low), F.regexp_count(col, F.lit(rule.regex))).otherwise(0) for rule in rules]
        )

    return F.transform(F.array(F.lower(col)), counts)[0]


def is_flagged(redacted: str | Column) -> Column:
    """Does redacted text carry a tag? A literal test: ``_`` is no wildcard here."""
    return F.contains(_column(redacted), F.lit(MARK))
