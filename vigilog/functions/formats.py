"""The five line formats.

Each format names the pattern of a whole line, the groups it keeps and a
function from these groups to event columns. Patterns accept exactly the lines
of the format; the part that may hold any character comes last in ``keep``.

Fixed values: the line patterns, the field names in them and the names of actions and
statuses are those of the log formats. The classes of blanks are adapted to the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilog.functions.http import http_attacks
from vigilog.functions.text import NS, S, any_of, joined, recast, tagged
from vigilog.functions.timestamps import clf_ts, iso_ts, parse_syslog_ts, recast_clf, recast_iso

_STAMP = rf"(\w+){S}+(\d+){S}+([\d:]+){S}+"
@dataclass(frozen=True)
class Groups:
    """Parts of a rewritten text: 0 is its tag, then the groups; NULL where there is none."""

    array: Column

    def __call__(self, i: int) -> Column:
        return F.get(self.array, F.lit(i + 1))

    def some(self, first: int, count: int) -> Column:
        """``count`` neighbouring parts as an array."""
        return F.slice(self.array, first + 2, count)


@dataclass(frozen=True)
class LineFormat:
    source: str
    pattern: str
    keep: tuple[int, ...]
    # what kind of event the line is, as a rewritten text
    detail: Callable[[Groups], Column]
    # (line groups, detail groups) -> map of further values
    extra: Callable[[Groups, Groups], Column]
    # the time as a rewritten text, where it needs a pattern of its own
    time: Callable[[Groups], Column] | None = None

    def recast(self, line: Column) -> Column:
        return recast(line, self.pattern, self.keep, anchored=True)


def _extra(names: tuple[str, ...], values: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), values)


# Every detail text has the fields ACTION, STATUS, SEVERITY, USER and up to three
# more that are named where they are used. As in the groups, '' stands for none.
ACTION, STATUS, SEVERITY, USER, MORE = range(5)
# fields after the first one; the last of them may hold any character
DETAIL_FIELDS = 5


def _classify(text: Column, *cases: tuple[tuple[str, ...], str, tuple[int, ...]]) -> Column:
    """Detail text of the first case whose pattern is found anywhere in the text."""
    for constants, pattern, groups in cases:
        text = recast(text, pattern, groups, tag=joined(*constants))
    return text


_ANY = ""


# ---- auth: [_, month, day, time, message], detail MORE = ip

def _auth_detail(g: Groups) -> Column:
    who = rf"({NS}+) from ([\d.]+)"
    return _classify(
        g(4),
        (("failed_login", "FAILED", "WARNING"), rf"Failed password for (?:invalid user )?{who}", (1, 2)),
        (("login", "SUCCESS", "INFO"), rf"Accepted password for {who}", (1, 2)),
        (("invalid_user", "FAILED", "WARNING"), rf"Invalid user {who}", (1, 2)),
        (("other", "", "INFO"), _ANY, (0, 0)),
    )


# ---- access: [_, method, status, ip, path, size, time]

def _access_detail(g: Groups) -> Column:
    method, status, path = g(1), g(2), g(4)
    # only digits get here, so a failed cast means a number too long for 38 digits
    code = F.coalesce(status.try_cast("decimal(38,0)"), F.lit(999))
    severity = F.when(code >= 500, "CRITICAL").when(code >= 400, "WARNING").otherwise("INFO")
    case = None
    for attack, test in http_attacks(path):
        detail = tagged(F.lit(attack), status, F.lit("CRITICAL"))
        case = F.when(test, detail) if case is None else case.when(test, detail)
    return case.otherwise(tagged(method, status, severity))


# ---- firewall: [_, month, day, time, src, dst, proto, spt, dpt, in, out, label], detail MORE = direction

def _firewall_detail(g: Groups) -> Column:
    label = g(11)
    direction = F.when((g(9) != "") & (g(10) == ""), "inbound").otherwise("outbound")
    # any other label is the action itself; it is taken from the line, where it may hold any character
    known = (
        F.when(any_of(label, ("BLOCK", "DROP")), joined("", "DROP", "DROP", "WARNING", ""))
        .when(any_of(label, ("ALLOW", "ACCEPT")), joined("", "ACCEPT", "ACCEPT", "INFO", ""))
        .otherwise(joined("", "", "", "INFO", ""))
    )
    return F.concat(known, tagged(direction))


def _firewall_extra(g: Groups, d: Groups) -> Column:
    values = F.concat(g.some(5, 4), F.array(d(MORE)), g.some(9, 2))
    return _extra(("dst", "proto", "src_port", "dst_port", "direction", "in_iface", "out_iface"), values)


# ---- syslog: [_, month, day, time, program, host, message], detail MORE, MORE + 1 = target user and command, or '' and service

def _syslog_detail(g: Groups) -> Column:
    message = g(6)
    command = rf"({NS}+){S}+:{S}+TTY={NS}+{S}+;{S}+PWD={NS}+{S}+;{S}+USER=({NS}+){S}+;{S}+COMMAND=(.+)"
    sudo = _classify(
        message,
        (("sudo_command", "SUCCESS", "INFO"), command, (1, 2, 3)),
        (("sudo_failed", "FAILED", "WARNING"), rf"({NS}+){S}+:{S}+[^;]*authentication failure", (1, 0, 0)),
        (("sudo_other", "", "INFO"), _ANY, (0, 0, 0)),
    )
    other = _classify(
        message,
        (("service_$1", "", "$1"), rf"(Stopped|Started|Stopping|Starting){S}+(.+)", (0, 0, 2)),
        # the name ends at a comma
        (("user_added", "", "WARNING"), rf"new user:{S}+name=([^\s\x1c-\x1f,]+)", (1, 0, 0)),
        (("syslog_other", "", "INFO"), _ANY, (0, 0, 0)),
    )
    return F.when(g(4) == "sudo", sudo).otherwise(other)


def _syslog_extra(g: Groups, d: Groups) -> Column:
    base, names = g.some(4, 2), ("program", "hostname")
    return (
        F.when(d(ACTION) == "sudo_command", _extra((*names, "target_user", "command"), F.concat(base, d.some(MORE, 2))))
        .when(d(ACTION).startswith("service_"), _extra((*names, "service"), F.concat(base, d.some(MORE + 1, 1))))
        .otherwise(_extra(names, base))
    )


# ---- fim: [_, timestamp, action, path, uid, gid, md5, sha256]

def _fim_detail(g: Groups) -> Column:
    changed = g(2).isin("modified", "deleted")
    return tagged(g(2), F.lit(""), F.when(changed, "WARNING").otherwise("INFO"))


FORMATS: tuple[LineFormat, ...] = (
    LineFormat(
        "auth",
        rf"{_STAMP}{NS}+{S}+{NS}+:{S}+(.+)",
        (1, 2, 3, 4),
        _auth_detail,
        lambda g, d: F.create_map().cast("map<string,string>"),
    ),
    LineFormat(
        "access",
        rf'([\d.]+) {NS}+ {NS}+ \[([^\]]+)\] "({NS}+) ({NS}+) {NS}+" (\d+) (\d+)',
        (3, 5, 1, 4, 6, 2),
        _access_detail,
        lambda g, d: _extra(("path", "size"), g.some(4, 2)),
        time=lambda g: recast_clf(g(6)),
    ),
    LineFormat(
        "firewall",
        rf"{_STAMP}{NS}+{S}+kernel:{S}+\[([^\]]+)\]{S}+IN=({NS}*){S}+OUT=({NS}*){S}+(?:MAC={NS}*{S}+)?"
        rf"SRC=([\d.]+){S}+DST=([\d.]+){S}+.*?PROTO=({NS}+){S}+(?:SPT=(\d+){S}+)?(?:DPT=(\d+))?",
        (1, 2, 3, 7, 8, 9, 10, 11, 5, 6, 4),
        _firewall_detail,
        _firewall_extra,
    ),
    LineFormat(
        "syslog",
        rf"{_STAMP}({NS}+){S}+({NS}+?)(?:\[\d+\])?:{S}+(.+)",
        (1, 2, 3, 5, 4, 6),
        _syslog_detail,
        _syslog_extra,
    ),
    LineFormat(
        "fim",
        rf"({NS}+){S}+fim:{S}+action=({NS}+){S}+path=({NS}+)(?:{S}+uid=(\d+))?(?:{S}+gid=(\d+))?"
        rf"(?:{S}+md5=({NS}+))?(?:{S}+sha256=({NS}+))?",
        (1, 2, 3, 4, 5, 6, 7),
        _fim_detail,
        lambda g, d: _extra(("path", "uid", "gid", "md5", "sha256"), g.some(3, 5)),
        time=lambda g: recast_iso(g(1)),
    ),
)


def event_ts(source: Column, g: Groups, t: Groups, year: Column) -> Column:
    """Time of an event: the first three groups of a syslog-style line, or the line's own time groups."""
    return (
        F.when(source == "access", clf_ts(t))
        .when(source == "fim", iso_ts(t))
        .otherwise(parse_syslog_ts(g(1), g(2), g(3), year))
    )


def _some(text: Column) -> Column:
    return F.when(text != "", text)


def event_fields(source: Column, g: Groups, d: Groups) -> dict[str, Column]:
    """The columns that all formats share; '' counts as missing."""
    label = F.when(source == "firewall", g(11))
    severity = d(SEVERITY)
    return {
        "ip": F.when(source == "auth", _some(d(MORE))).when(source == "access", g(3)).when(source == "firewall", g(4)),
        "user": _some(d(USER)),
        "action": F.when(source == "syslog", F.lower(d(ACTION))).otherwise(F.coalesce(_some(d(ACTION)), label)),
        "status": F.coalesce(_some(d(STATUS)), label),
        # a service event carries its verb
        "severity": F.when(severity.isin("INFO", "WARNING", "CRITICAL"), severity)
        .when(severity == "Stopped", "WARNING")
        .otherwise("INFO"),
        "path": F.when(source == "access", g(4)).when(source == "fim", g(3)),
        "direction": F.when(source == "firewall", d(MORE)),
    }


def by_source(source: Column, formats: tuple[LineFormat, ...], pick: Callable[[LineFormat], Column | None]) -> Column:
    """CASE over the source name; sources without a branch give NULL."""
    result = None
    for fmt in formats:
        branch = pick(fmt)
        if branch is not None:
            result = F.when(source == fmt.source, branch) if result is None else result.when(source == fmt.source, branch)
    return F.lit(None) if result is None else result

