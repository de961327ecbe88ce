"""Words that mean "no value", one list for each use (they differ on purpose), patterns and limits."""

# Allele tokens without a call.
NO_ALLELE = ["", "0", "-", "?", "none", "null", "unknown", "na", "n/a"]
# Typing schemes and versions that are not known.
NO_SCHEME = ["", "unknown", "none", "null", "na", "n/a", "?", "-"]
# Lineage codes that are missing.
NO_CODE = ["", "na", "n/a", "none", "null", "unknown", "-"]
# Collection dates that are missing.
NO_DATE = ["", "unknown", "none", "null", "na", "n/a", "not provided", "missing", "not collected"]
# Hosts that are not known, and other states that are not known.
NO_HOST = ["", "unknown", "none", "na", "n/a", "not provided", "not available"]
NO_STATE = ["", "unknown", "none", "na", "n/a", "not provided", "not available", "null", "nan"]
# Profile and lineage statuses that block use.
BLOCKED_PROFILE = ["conflict", "failed", "unassigned", "unsupported"]
BLOCKED_LINEAGE = ["conflict", "malformed", "unsupported", "missing", "unassigned", "failed"]
# Origins that mean an input record.
INPUT_ORIGINS = ["local", "query", "focal", "input"]

LINEAGE_COMPONENTS = 10
MIN_ROBUST_Z, MIN_MEDIAN_RATIO = 10.0, 5.0

RUN_ACCESSION = r"^[SED]RR\d+$"
SAMPLE_ACCESSION = r"^SAM[NED][A-Z]?\d+$"
ASSEMBLY_ACCESSION = r"^GC[AF]_\d+(\.\d+)?$"
STRONG_ACCESSION = r"^([SED]RR\d+|SAM[NED][A-Z]?\d+|GC[AF]_\d+(\.\d+)?)$"
