"""Fixed values.

Everything in the first block must equal the values the original review and
summary jobs use, character for character, or tickets, comments and prompts
come out different. They are stated here once, in natural order, and every
operator reads them from this module.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original jobs exactly)
# ---------------------------------------------------------------------------

# Tag dictionary: name, description (11 entries, in manifest order).
TAGS = [
    ("bug", "This is a bug"),
    ("complaint", "This is a complaint"),
    ("question", "This is a question"),
    ("general_feedback", "This is a feedback"),
    ("suggestion", "suggestion"),
    ("praise", "praise"),
    ("security_concern", "security concern"),
    ("pricing", "pricing"),
    ("Positive", "positive"),
    ("Negative", "negative"),
    ("failed_to_infer_category", "Failed to infer category"),
]
FALLBACK_CATEGORY = "failed_to_infer_category"

# Categories the annotation prompt asks for.
CATEGORIES = [
    "bug", "complaint", "general_feedback", "suggestion",
    "praise", "security_concern", "pricing", "question",
]

# Sub-category rules of the prompt, keyed by category. "praise" takes free
# text (the benefit received); "suggestion" names none ("unspecified").
SUB_CATEGORY_RULES = {
    "bug": ["blocking", "major", "minor", "trivial"],
    "complaint": ["functional", "usability", "performance", "customer service"],
    "general_feedback": ["-"],
    "security_concern": ["vulnerability", "privacy issue"],
    "question": ["-"],
    "pricing": ["expensive", "cheap", "value for money"],
    "suggestion": ["unspecified"],
}
FREE_TEXT_SUB_CATEGORY = "praise"

SEVERITIES = ["Blocker", "High", "Low", "Medium"]

# Model names the job configuration may ask for (33 values, manifest order).
ALLOWED_MODELS = [
    "qwen-72b-chat",
    "elyza-japanese-llama-2-7b-fast-instruct",
    "firellava-13b",
    "japanese-llava-mistral-7b",
    "japanese-stablelm-instruct-beta-70b",
    "japanese-stablelm-instruct-gamma-7b",
    "japanese-stable-vlm",
    "llamaguard-7b",
    "llama-v2-13b",
    "llama-v2-13b-chat",
    "llama-v2-13b-code",
    "llama-v2-13b-code-instruct",
    "llama-v2-34b-code",
    "llama-v2-34b-code-instruct",
    "llama-v2-70b",
    "llama-v2-70b-chat",
    "llama-v2-7b",
    "llama-v2-7b-chat",
    "llava-codellama-34b",
    "llava-v15-13b-fireworks",
    "mistral-7b",
    "mistral-7b-instruct-4k",
    "mixtral-8x7b",
    "mixtral-8x7b-instruct",
    "qwen-14b-chat",
    "qwen-1-8b-chat",
    "stablecode",
    "stablelm-zephyr-3b",
    "starcoder-16b-w8a16",
    "starcoder-7b-w8a16",
    "yi-34b-200k-capybara",
    "yi-6b",
    "zephyr-7b-beta",
]
DEFAULT_MODEL = "mixtral-8x7b-instruct"
DEFAULT_LIMIT = 10

# Inference request settings of every job.
INFERENCE_PARAMS = {
    "max_tokens": 4096, "top_p": 1, "top_k": 40, "presence_penalty": 0,
    "frequency_penalty": 0, "temperature": 0.6,
    "response_format": {"type": "json_object"},
}

# Ticket titles per channel; {key} is the channel's first non-empty identifying field.
TITLE_TEMPLATE = {
    "social": "Ticket created from twitter: {key}",
    "appstore": "Ticket created from Trustpilot: {key}",
    "product": "Ticket created from G2 {key}",
    "business": "Ticket created from google review by {key}",
    "domain": "Ticket created from Trustpilot: {key}",
}

# Ticket body; {indent_a} and {indent_b} are runs of spaces, (a, b) per channel.
BODY_TEMPLATE = "The review: {text} \n\n{indent_a}The description: {description} \n\n{indent_b}"
BODY_INDENTS = {
    "social": (6, 8),
    "appstore": (4, 6),
    "product": (2, 4),
    "business": (4, 6),
    "domain": (4, 6),
}

# Detail comments, in posting order; {indent} is a run of spaces per channel.
COMMENT_TEMPLATES = [
    "<b>Sub-Category</b>: {sub_category} ",
    "Overall sentiment: {sentiment} ",
    "Feature discussed: {feature} ",
    "Actionable insight: \n\n{indent}{insight} \n",
    "Sample Response: {response} ",
]
PRODUCT_SUBCAT_TEMPLATE = "Sub-Category: {sub_category} "   # product channel, first comment
INSIGHT_INDENT = {"social": 4, "appstore": 4, "product": 4, "business": 2, "domain": 4}
CHART_CHANNELS = ("appstore", "domain")
CHART_COMMENT = (
    '<img src="https://quickchart.io/chart?c=%7Btype%3A%27bar%27%2Cdata%3A%7Blabels%3A%5B%27'
    'Hello+world%27%2C%27Fo+bar%27%5D%2Cdatasets%3A%5B%7Blabel%3A%27Foo%27%2Cdata%3A%5B1%2C2%5D'
    '%7D%5D%7D%7D&w=500&h=300&bkg=%23ffffff&f=png&v=2"></img> '
)

# Status message after a ticket is created; visible for one minute.
STATUS_CATEGORIZED = "Created ticket: <{ticket}> and it is categorized as {category}"
STATUS_FAILED = "Created ticket: <{ticket}> and it failed to be categorized"
STATUS_TTL_MINUTES = 1

# Summary report entries, in posting order.
REPORT_TEMPLATES = [
    "Positive sentiment %: {positive_pct} ",
    "Negative sentiment %: {negative_pct} ",
    "Customer likings: {customer_likings}",
    "Customer Pain-Points: {customer_pain_points}",
    "Areas to focus on:   \n\n{focus} \n",
    "Actions to take: {actions}",
]

# Link prefix the annotation prompt asks to remove.
LINK_PREFIX = "https://t.co/"

# Review-text wrapper (built, never sent, by the product job).
REVIEW_WRAPPER = "The Review: "

# Annotation prompt; {company} and {review} are the two placeholders.
ANNOTATION_PROMPT = (
    'you are an expert at cleaning, lablelling, categorising and analysing the given Trustpilot '
    'reviews for the company {company}. You will recieve a review. The output should be json '
    'with fields: "Relevance", "Sentiments", "Category", "sub_category", "Severity", "Feature" , '
    '"insight", "description", "response" and "review". Under "Relevance" write false if the '
    'text is not related to the company or it is a general statement otherwise mention true. '
    'Under "Sentiment" mention the sentiment of the tweet between "Positive" or "Negative". For '
    '"Category" choose only between a "bug", "complaint", "general_feedback", "suggestion", '
    '"praise", "security_concern", "pricing" or "question". Under "sub_category" if "Category" '
    'is "bug" then choose between "blocking", "major", "minor" or "trivial", if "Category is '
    '"complaint" choose between "functional", "usability", "performance" or "customer '
    'service", if "Category" is "general feedback" then "sub_category" will be "-" , if '
    '"Category" is "security_concern" then "sub_category" will be "vulnerability" or "privacy '
    'issue", if "Category" is "question" then "sub_category" will be "-" , if "Category" is '
    '"pricing" then "sub_category" will be "expensive", "cheap" or "value for money", if '
    '"Category" is "praise" then "sub_category" will be what benefit was received. Under '
    '"Feature" mention the feature that the review is about.Under "Severity" choose between '
    '"Blocker", "High", "Low" or "Medium". Under "insight" mention the action elaborately that '
    'the company should take based on the review. Under "description" mention the elaborate '
    'description of the problem. Under "response" add an elaborate professional response to '
    'the customer from the company. Under "review" add the review after removing all links '
    'starting with "https://t.co/". The review: {review}'
)

# Alternate product prompt (built, never sent, by the product job).
PRODUCT_ALT_PROMPT = (
    'you are an expert at cleaning, lablelling, categorising and analysing the given G2 reviews '
    'for the company {company}.You will recieve a review. The output should be json with '
    'fields: "Relevance", "Sentiments", "Category", "sub_category", "Severity", "Feature" , '
    '"insight", "description", "response" and "review". Under "Relevance" write false if the '
    'text is not related to the company or it is a general statement otherwise mention true. '
    'Under "Sentiment" mention the sentiment of the tweet. For "Category" mention if is a '
    '"bug", "complaint", "general_feedback", "suggestion", "praise", "security_concern", '
    '"pricing" or "question". Under "sub_category" if "Category" is "bug" then choose between '
    '"blocking", "major", "minor" or "trivial", if "Category is "complaint" choose between '
    '"functional", "usability", "performance" or "customer service", if "Category" is '
    '"general feedback" then "sub_category" will be "-" , if "Category" is "security concern" '
    'then "sub_category" will be "vulnerability" or "privacy issue", if "Category" is '
    '"question" then "sub_category" will be "-" , if "Category" is "pricing" then '
    '"sub_category" will be "expensive", "cheap" or "value for money", if "Category" is '
    '"praise" then "sub_category" will be what benefit was received. Under "Feature" mention '
    'the feature that the review is about.Under "Severity" choose between "blocker", "high", '
    '"low" or "medium". Under "insight" mention the action elaborately that the company should '
    'take based on the review. Under "description" mention the elaborate description of the '
    'problem. Under "response" add an elaborate professional response to the customer from '
    'the company. Under "review" add the review after removing all links starting with '
    '"https://t.co/". Review: {review}'
)

# Summary prompt; {positive_pct} and {reviews} are the placeholders.
SUMMARY_PROMPT = (
    'you are an expert at analysing voice of customer data. You are given an array of '
    'reviews. The output will be in json format with fields: "customer_likings": here explain '
    'what the customers are liking breifly, "customer_pain_points": here explain the pain '
    'points customer are facing briefly, "focus": here give the topic names the company '
    'should focus on and "actions": here give all the neseccary actions the company should '
    'take in breif pointers and this is their positive sentiment%: {positive_pct} give '
    'recommendation on how they can improve. The reviews: {reviews} '
)

# ---------------------------------------------------------------------------
# Our own choices (not from the original jobs)
# ---------------------------------------------------------------------------

# Channel names of the canonical review table, in the order used by the test views.
CHANNELS = ["social", "appstore", "product", "business", "domain"]

# Payload envelope key per channel.
ENVELOPE = {
    "social": "results",
    "appstore": "data",
    "product": "initial_reviews",
    "business": "reviews",
    "domain": "reviews",
}

TAG_ID_PREFIX = "tag/"
TICKET_TYPE = "ticket"
BODY_TYPE = "text"
ENTRY_TYPE = "timeline_comment"
VISIBILITY = "internal"

# Per-channel job configuration: subject id, default part, default owner, model.
JOB_CONFIG = [
    ("social", "acme", "part/social", "owner/social", "mixtral-8x7b-instruct"),
    ("appstore", "com.acme.app", "part/appstore", "owner/appstore", "mixtral-8x7b-instruct"),
    ("product", "acme-suite", "part/product", "owner/product", "llama-v2-70b-chat"),
    ("business", "Acme Store", "part/business", "owner/business", "mistral-7b-instruct-4k"),
    ("domain", "acme.example", "part/domain", "owner/domain", "zephyr-7b-beta"),
]

# Default chunk size (characters) for corpus summaries.
SUMMARY_CHUNK_CHARS = 200_000
