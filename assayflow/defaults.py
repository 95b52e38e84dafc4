"""Default parameters of the operators.

Fixed values: results are only comparable when these numbers stay as they are.
"""

# Cleaning
MISSING_THRESHOLD = 0.6
MISSING_THRESHOLD_STRICT = 0.5
MIN_SIMILARITY = 60

# Outliers
PH_RANGE = (0, 14)
TEMPERATURE_RANGE = (-10, 120)
MAX_UNKNOWN_FRACTION = 0.2
FENCE = 1.5
FENCE_GRID = (1.5, 2.0, 2.5, 3.0, 3.5, 4.0)
TARGET_RATE = 0.05
MIN_GROUP_SIZE = 50
MAD_CUTOFF = 5.0
MAD_SCALE = 1.4826
CONTAMINATION = 0.01

# Features
CORRELATION_THRESHOLD = 0.90
BIT_VARIANCE_THRESHOLD = 0.01
PCA_COMPONENTS = 200
FINGERPRINT_BITS = 256
SEED = 42

# Column names of the measurement table
TARGETS = ("kcat_km", "kcat_value", "km_value")
TEXT_DUPLICATES = ("kcat", "km")
ID_COLUMNS = ("cid", "brenda_id")
SIMILARITY_COLUMNS = ("max_enzyme_similarity", "max_organism_similarity")
NOT_FEATURES = (
    "kcat_km", "max_enzyme_similarity", "max_organism_similarity", "sequence_length",
    "pmid", "uniprot_id", "sequence_source", "pH", "temperature",
)
