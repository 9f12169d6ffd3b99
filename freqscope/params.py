"""Default parameters of the jobs.

The values in the block marked FIXED VALUES must equal the behaviour being
reproduced (seeds, primes, hash layouts); everything else is a tunable default
for the test tables.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must not change: they define hash families and seeds)
# ---------------------------------------------------------------------------
# Query-log sketches: 2-universal family over md5 token ids.
TOKEN_DEPTH = 5
TOKEN_WIDTHS = (1024, 16384, 262144)  # 2^10, 2^14, 2^18
MERSENNE_61 = 2305843009213693951  # 2^61 - 1
TOKEN_TOP_TRACKED = 500
TOKEN_TRUE_TOP = 100
TOKEN_EVAL_SET_SIZE = 100
# Seeded sha256 row hash seeds per windowed model.
RING_SEED = 42
DYADIC_SEED = 42
BURST_SEED = 777
DECAY_SEED = 12345
# MinHash / LSH.
MINHASH_PRIME = 4294967311
LSH_K = 2
LSH_L = 50
LSH_NUM_QUERIES = 200
LSH_QUERY_SEED = 42
TOKEN_SAMPLE_SEED = 18147
LSH_TUNE_K = (2, 3, 4, 5, 6)
LSH_TUNE_L = (20, 50, 100)
SHINGLE_N = 3
LSH_PRUNE_K, LSH_PRUNE_L = 6, 20   # bands so long that few pairs meet
LSH_BUCKETS = (0, 4096)            # buckets of a table; 0: one for each different band
URL_BYTES = 2048              # bound on a URL's text where a list of query URLs is broadcast
# Bloom filter.
BLOOM_SEED = 42
BLOOM_FP_TARGETS = (0.01, 0.001, 0.0001)
# Avalanche analysis.
AVALANCHE_PRIME = 1048573
AVALANCHE_INPUT_BITS = 31
AVALANCHE_OUTPUT_BITS = 10
AVALANCHE_COEFF_SEED = 42
# Burst score smoothing.
BURST_EPSILON = 1e-9
# ---------------------------------------------------------------------------

# Tunable defaults for the windowed-count jobs on the `events` table.
ITEM_BYTES = 4096            # bound on an item's text where a list of items is broadcast
SLOT_SECONDS = 3600          # one slot = one hour on the test tables
BUCKET_SLOTS = 10            # burst buckets
RECENT_BUCKETS = 4
HISTORY_BUCKETS = 12
RECENT_SLOTS = 10            # slot-level burst series
HISTORY_SLOTS = 50
SLIDING_SLOTS = 32
EVAL_LAST_SLOTS = 512
TOP_K = 5
DEPTH = 4
WIDTH = 64
DYADIC_LEVELS = 4
DYADIC_MIN_WIDTH = 32
DECAY_LAMBDA = 0.01
SWEEP_WIDTHS = (16, 32, 64, 128)
SWEEP_DEPTHS = (2, 4)
NUM_EVAL_POINTS = 10
HIST_BINS = 20
ROUND_DIGITS = 6

# Broadcast a side only when a bound derived from parameters (never from the
# data) says it is at most this many bytes; otherwise the planner shuffles.
BROADCAST_BOUND_BYTES = 64 * 1024 * 1024
