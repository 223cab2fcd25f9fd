"""Default parameters of the operators.

Fixed values: these equal the reference's settings, so results match it when defaults are used.
"""

# Fixed values (reference settings), in pipeline order
WINDOW = 10               # rolling mean / std window (minimum 1 row)
EMA_SPAN = 10             # exponential mean span, adjusted weights (minimum 1 row)
TEST_SIZE = 0.3           # share of scenarios outside train
VAL_SIZE = 0.5            # share of that remainder going to validation
SEED = 42                 # split order, sampling, synthetic rows, models
N_CLASSES = 6             # classes 0-5 of every label
MIN_CLASS_ROWS = 100      # balance a label when its smallest class is below this
SMOTE_K = 5               # neighbours for synthetic rows
MIN_COMBO_ROWS = 5        # combination balancing runs when the rarest combination reaches this
SEQ_LEN = 20              # sequence length
TRAIN_STEP = 15           # stride of training sequences
EVAL_STARTS = 10          # evenly spaced starts per scenario for validation / test sequences
RANDOM_SEQUENCES = 50     # scenarios drawn for the random sequence subset
TOP_COMBOS = 10           # label combinations listed
CV_FOLDS = 3              # grid search folds
CV_DEPTHS = (3, 5)        # tree depths searched
CV_PARALLELISM = 2        # grid search workers
N_TREES = 100             # trees per model
LEARNING_RATE = 0.1       # boosting step
SUBSAMPLE = 0.8           # rows per tree
COLSAMPLE = 0.8           # features per tree
MAX_BINS = 256            # histogram bins
HYBRID_STEPS = 10         # first blend-weight search: 0, 0.1, ..., 1
WEIGHT_STEPS = 20         # optimised blend-weight search: 0, 0.05, ..., 1
DEFAULT_WEIGHT = 0.5      # blend weight when none is known or none beats 0
STD_EPS = 1e-8            # added to the standard deviation in normalisation
TOP_IMPORTANCES = 20      # feature importances listed per label
