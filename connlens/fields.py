"""The connection record: names, types, labels and named feature groups."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: the published record layout, in field order ------------------------------
FIELD_NAMES = [
    "duration",
    "protocol_type",
    "service",
    "flag",
    "src_bytes",
    "dst_bytes",
    "land",
    "wrong_fragment",
    "urgent",
    "hot",
    "num_failed_logins",
    "logged_in",
    "num_compromised",
    "root_shell",
    "su_attempted",
    "num_root",
    "num_file_creations",
    "num_shells",
    "num_access_files",
    "num_outbound_cmds",
    "is_host_login",
    "is_guest_login",
    "count",
    "srv_count",
    "serror_rate",
    "srv_serror_rate",
    "rerror_rate",
    "srv_rerror_rate",
    "same_srv_rate",
    "diff_srv_rate",
    "srv_diff_host_rate",
    "dst_host_count",
    "dst_host_srv_count",
    "dst_host_same_srv_rate",
    "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate",
    "dst_host_srv_diff_host_rate",
    "dst_host_serror_rate",
    "dst_host_srv_serror_rate",
    "dst_host_rerror_rate",
    "dst_host_srv_rerror_rate",
    "attack",
]

LABELS = [
    "back.",
    "buffer_overflow.",
    "ftp_write.",
    "guess_passwd.",
    "imap.",
    "ipsweep.",
    "land.",
    "loadmodule.",
    "multihop.",
    "neptune.",
    "nmap.",
    "normal.",
    "perl.",
    "phf.",
    "pod.",
    "portsweep.",
    "rootkit.",
    "satan.",
    "smurf.",
    "spy.",
    "teardrop.",
    "warezclient.",
    "warezmaster.",
]

NORMAL = "normal."

CATEGORY_POSITIONS = {1, 2, 3}
LABEL_POSITION = 41
RATE_POSITIONS = set(range(24, 31)) | set(range(33, 41))

# Positions left out because another variable of the same correlated group is kept.
CORRELATED_POSITIONS = {25, 27, 35, 38, 40}
# Positions whose chi-square p-value is near 1.
UNRELATED_POSITIONS = {6, 19}
# ---- End of fixed values --------------------------------------------------------------------

FIELD_COUNT = len(FIELD_NAMES)
LABEL = FIELD_NAMES[LABEL_POSITION]
CATEGORIES = [FIELD_NAMES[p] for p in sorted(CATEGORY_POSITIONS)]


def field_type(position: int) -> T.DataType:
    if position in CATEGORY_POSITIONS or position == LABEL_POSITION:
        return T.StringType()
    return T.DoubleType() if position in RATE_POSITIONS else T.LongType()


INTERACTION_SCHEMA = T.StructType(
    [T.StructField(name, field_type(position)) for position, name in enumerate(FIELD_NAMES)]
)

NARROW_FIELDS = FIELD_NAMES[:6] + [LABEL]


def _without(dropped: set[int]) -> list[str]:
    return [n for p, n in enumerate(FIELD_NAMES) if p not in dropped | {LABEL_POSITION}]


FEATURE_GROUPS = {
    "numeric": _without(CATEGORY_POSITIONS),
    "uncorrelated": _without(CATEGORY_POSITIONS | CORRELATED_POSITIONS),
    "categorical_like": FIELD_NAMES[6:LABEL_POSITION],
    "chi_selected": _without(CATEGORY_POSITIONS | UNRELATED_POSITIONS),
    "all_indexed": _without(set()),
}
