"""Default parameters shared by the operators.

Fixed values: the prompt wording, the answer tokens and the numeric settings below must stay as they are for
prompts, labels and samples to come out right.
"""

SEED = 22

SYSTEM_PROMPT = (
    "You are given a comment from reddit and a rule. "
    "Your task is to classify whether the comment violates the rule. "
    "Only respond Yes/No.\n"
)
JUDGE_WORDS = "Violation:"
POSITIVE_TOKEN = "Yes"
NEGATIVE_TOKEN = "No"

PSEUDO_FRACTION = 0.05
ENSEMBLE_WEIGHTS = (0.6, 0.4)
TRIPLET_MARGIN = 0.25
TRAIN_BATCH_SIZE = 32
WARMUP_SHARE = 0.1
EMBED_BATCH_SIZE = 64
REPLY_BATCH_SIZE = 8

EXAMPLE_COLUMNS = (
    "positive_example_1",
    "positive_example_2",
    "negative_example_1",
    "negative_example_2",
)
