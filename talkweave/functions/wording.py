"""The wording of prompts.

These texts are part of the result (a prompt is only comparable with another run's if every
character agrees), so they are stated here as they have to appear, spelling included.
"""

# system part
ROLE = "You are an AI expert in categorizing sentences into classes."
CONTEXT = (
    "Another assistant has retrieved some documents that might be useful for you to understand "
    "the context of the conversation, do not use them if not relevant."
)
CODEBOOK_OPEN = (
    "You can use the following codebook (with classes, definitions and examples) to help you "
    "ccategorize the sentence:\n### IMPORTANT CODEBOOK:\n"
)
CODEBOOK_CLOSE = "\n###\n"
CLASSES_OPEN = "You need to categorize the new sentence into one of the following classes: ["
CLASSES_CLOSE = "].\n"
OTHERWISE = (
    "If you fail to categorize the sentence, return 'None' instead of coming up with a wrong "
    "class.\n"
)
HISTORY = "You can use the history of the conversation to help you categorize the sentence."
READY = "Ok, let's start!"
ANSWER = "Class: "

# ensemble
ENSEMBLE_ROLE = (
    "You are an human ensemble. You have to decide the right categorization across some experts "
    "on the field.\nYou will receive some information about the classes, the text and the other "
    "expert predictions.\n"
)
ENSEMBLE_ASK = "Can you give me some hits from the experts?"
ENSEMBLE_OPEN = "Some experts came up with the following categorizations about the last sentence.\n"
EXPERT_LINE = ("Expert ", " categorized the sentence as class: ", ".\n")
ENSEMBLE_CLOSE = (
    "What class do you this is the correct one? Answer this question with only the class that "
    "you think it's right.\n"
)

# explanation
EXPLAIN = (
    "Based on the previous chat, can you explain to me why you have chosen this class in a two "
    "sentences? Use at most one hundred words. Please reference parts of the input message when "
    "explaining your decision."
)

# few-shot request
FEWSHOT_REQUEST = "Provide me uptake category of this line \n\n"
