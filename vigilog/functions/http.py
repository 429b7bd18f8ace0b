"""Attack classes of a request path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks a path as an attack, as the input format defines it. Only the class of blanks is adapted, to
# the regular expressions of the JVM; a blank in a URL may be written "+".
_B = r"[\s\x1c-\x1f+]"
_S = r"[\s\x1c-\x1f]"
SQL_INJECTION_PATTERNS = (
    rf"(?:union{_B}+select|select{_B}+.*from|insert{_B}+into|delete{_B}+from|drop{_B}+table|update{_B}+.*set)",
    rf"(?:'{_B}*or{_B}+'1'{_B}*={_B}*'1|'{_B}*or{_B}+1{_B}*={_B}*1|'{_B}*--)",
    rf"(?:;{_B}*(?:drop|delete|insert|update|alter){_B})",
)
XSS_PATTERNS = (
    r"<script[^>]*>",
    rf"javascript{_S}*:",
    rf"on(?:error|load|click|mouseover){_S}*=",
    r"<img[^>]+onerror",
)
WEB_SHELLS = (
    "/c99.php",
    "/r57.php",
    "/shell.php",
    "/cmd.php",
    "/webshell.php",
    "/b374k.php",
    "/wso.php",
    "/alfa.php",
    "/filemanager.php",
    "/upload.php",
    "/backdoor.php",
)

SQL_INJECTION = "(?Uid)" + "|".join(SQL_INJECTION_PATTERNS)
XSS = "(?Uid)" + "|".join(XSS_PATTERNS)


def is_web_shell(path: Column) -> Column:
    lowered = F.lower(path)
    hit = F.lit(False)
    for suffix in WEB_SHELLS:
        hit = hit | lowered.endswith(suffix)
    return hit


def http_attacks(path: Column) -> list[tuple[str, Column]]:
    """The attack classes with their tests, in order of precedence."""
    return [
        ("sql_injection", path.rlike(SQL_INJECTION)),
        ("xss_attempt", path.rlike(XSS)),
        ("web_shell", is_web_shell(path)),
    ]


def classify_http_attack(path: Column) -> Column:
    """``sql_injection``, ``xss_attempt``, ``web_shell`` (in this precedence) or NULL."""
    return F.coalesce(*[F.when(test, name) for name, test in http_attacks(path)])
