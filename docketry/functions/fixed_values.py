"""Word lists, patterns, weights and sentinels that results depend on.

Fixed values: every list below must keep its members (and, where the first match wins,
its order) for the rules to give the intended result. Company and product words are not
listed; callers pass them through the ``*_terms`` parameters of the operators.
"""

# --- fixed values: payment methods counted by the cash rule
PAYMENT_WORDS = [
    "cash", "money order", "credit", "visa", "amex", "debit", "cheque", "charge", "mc", "db",
    "check", "credit card", "refund", "roa", "grant", "master", "cq",
]

# --- fixed values: invoice and register keywords, first keyword with a digit token wins
INVOICE_KEYWORDS = ["invoice number", "invoice #", "invoice num", "invoice#"]
REGISTER_KEYWORDS = [
    "phn/reg", "reg#", "reg #", "register#", "register #", "register number", "reg no", "register no",
]
KEYWORD_WINDOW = 25

# --- fixed values: amounts
DOLLAR_AMOUNT = r"[$][\d{1,3},?]*\d{1,3}\.\d{2}"
BARE_AMOUNT = r"[\d{1,3},?]*\d{1,3}\.\d{2}"
ANY_AMOUNT = r"\d\.\d{2}"

# --- fixed values: address windows
ADDRESS_WINDOW = 80
POSTAL_IN_WINDOW = r"[a-zA-Z](\d|i|o|s)[a-zA-Z]\s?(\d|i|o|s)[a-zA-Z](\d|i|o)\s"
POSTAL_STANDALONE = r"\s[a-zA-Z](\d|i|o)[a-zA-Z]\s?(\d|i|o)[a-zA-Z](\d|i|o)\s"
ROAD_WORDS = [
    "avenue", "ave", "boulevard", "blvd", "circle", "cir", "court", "ct", "expressway", "expy",
    "freeway", "fwy", "lane", "ln", "parkway", "pky", "road", "rd", "square", "sq", "street", "st",
    "driveway", "dr", "drive", "highway", "hwy",
]
PROVINCE_WORDS = [
    "albert", "ab", "british columbia", "bc", "manitoba", "mb", "new brunswick", "nb",
    "newfoundland and labrador", "nl", "northwest territories", "nt", "nova scotia", "ns",
    "nunavut", "nu", "ontario", "on", "prince edward island", "pe", "quebec", "qc",
    "saskatchewan", "sk", "yukon", "yt",
]

# --- fixed values: contact details
PHONE_PATTERN = r"[(]?\d{3}[)|\-|\s|\.]\s?\d{3}[\-|\s|\.]\d{4}"
FAX_KEYWORDS = ["fax:", "fax", "f:"]
FAX_WINDOW = 30
# Possessive runs and the look-behind keep the scan linear; the matches are those of
# ([A-Za-z0-9]+[-_])*[A-Za-z0-9]+@[A-Za-z0-9-\s]+(\.\s*[A-Z|a-z]{2,})+
EMAIL_PATTERN = r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]++[-_])*+[A-Za-z0-9]++@[A-Za-z0-9\s-]+(?:\.\s*[A-Z|a-z]{2,})+"

# --- fixed values: date patterns and the layout each is read with once punctuation is a space
DATE_FORMATS = [
    (r"(?U)\w{3,4}[\s|-]\d+[,|/]?[\s|-]?20\d{2}", "MMM d yyyy"),
    (r"(?U)\d+[\s|-]\w{3,4}[\s|-]20\d{2}", "d MMM yyyy"),
    (r"\d{2}/\d{2}/20\d{2}", "M d yyyy"),
    (r"20\d{2}/\d{2}/\d{2}", "yyyy M d"),
    (r"(?U)\d{2}-\w{3,4}-\d{2}\s", "d MMM yy"),
]
DATE_FORMATS_WIDE = [
    (r"(?U)\w{3,9}[\s|-]\d+[,|/]?[\s|-]?20\d{2}", "MMM d yyyy"),
    (r"(?U)\d+[\s|-]\w{3,9}[\s|-]20\d{2}", "d MMM yyyy"),
    (r"\d{1,2}[/|-]\d{1,2}[/|-]20\d{2}", "M d yyyy"),
    (r"20\d{2}[/|-]\d{2}[/|-]\d{2}", "yyyy M d"),
    (r"(?U)\d{2}-\w{3,9}-\d{2}\s", "d MMM yy"),
]

# --- fixed values: page-label words
CLAIM_FORM_PHRASES = [
    "group benefits retiree extended health care claim",
    "group benefits extended health care claim",
    "group benefits medical expense claim",
    "group benefits assignment of paramedical",
]
CLAIM_FORM_PHRASES_SHORT = CLAIM_FORM_PHRASES + ["extended health care claim"]
CLAIM_ONE_MARKS = ["plan member information", "1 of 2"]
CLAIM_ONE_FIELDS = [
    "plan contract number", "plan member certificate number", "plan member name", "birthday",
    "plan member information", "plan member address", "spouse", "dependants",
    "patient information", "date of birthday", "page 1 of 2", "complete for all expenses",
    "use one line per patient", "prescription drug expenses",
]
CLAIM_ONE_FIELDS_WIDE = CLAIM_ONE_FIELDS + ["plan no", "plan sponsor", "employee name", "mailing address"]
ALT_FORM_FIELDS = [
    "member basic personal information", "patient information", "perscription drug expenses",
    "page 1 of 2", "identification number", "plan number",
]
CLAIM_TWO_MARKS = [
    "equipment and appliance", "vision care expenses", "claims confirmation",
    "mailing instruction", "banking information and email address", "2 of 2",
]
CLAIM_TWO_FIELDS = [
    "equipment and appliance", "vision care expenses", "claims confirmation",
    "mailing instruction", "banking information and email address", "page 2 of 2",
    "please mail your completed", "total amount of all receipts",
]
DRUG_MARKS = ["pharmacy", "drug mart", "prescription"]
DRUG_GATE_WORDS = ["pharmacy", "drug", "pharmacies", " din ", " rx "]
DRUG_WORDS = [
    "pharmacy", "drug", "prescription", " din ", " rx ", " mfr ", " pays ", " dr ", "pharmacies",
    " total ", " fee ", " cost ", "receipt", "medication record",
]
DRUG_WORDS_WIDE = DRUG_WORDS + [" c ", " f ", " t "]
OFFICIAL_RECEIPT = "official prescription receipt"
RECEIPT_WORDS = ["receipt", "invoice"]
RECEIPT_DETAIL_WORDS = ["date", "service", "items", "payments"]
RECEIPT_EXCLUSIONS = ["customer copy", "claim"]
THERAPY_WORDS = [
    "clinic", "treatment", "therapy", "massage", "physiotherapist", "chiropractor",
    "psychologist", "physiotherapy", "chiropractic",
]
BILLING_WORDS = ["invoice", "receipt", "bill", "paid"]
HEALTH_RECEIPT_WORDS = ["inv", "receipt", "billing", "statement", "estimate"]
HEALTH_DRUG_EXCLUSIONS = ["drug", "pharma", "prescription", " rx "]
AMOUNT_WORDS = ["payment", "subtotal", "paid", "balance", "amount due", "amount", "total"]
REFERRAL_WORDS = [
    "acupuncture", "athletic therapy", "audiolog", "chiropod", "chiroprac", "christian science",
    "homeopath", "kinesiolog", "massage therapy", "osteopath", "physio", "podiatr", "psychiatr",
    "psycholog", "psychoanal", "psychotherap", "shiatsu therap", "speech therap", "reflexolog",
    "eye exam", "visual training",
]

# --- fixed values: score weights, bound to feature names
SCORE_WEIGHTS = {
    "paid_by_cash&payment_below": 0.0475,
    "has_stamp&payment_below": 0.095,
    "no_dollar_symbol&payment_below": 0.005,
    "above_handwritten_threshold&payment_below": 0.06,
    "invalid_invoice_nbr&payment_below": 0.025,
    "invalid_addr&payment_below": 0.0175,
    "paid_by_cash&payment_above": 0.38,
    "has_stamp&payment_above": 0.19,
    "no_dollar_symbol&payment_above": 0.02,
    "above_handwritten_threshold&payment_above": 0.24,
    "invalid_invoice_nbr&payment_above": 0.1,
    "invalid_addr&payment_above": 0.07,
}
BULK_WEIGHT = {"has_bulk_treatment": 0.02}

# --- fixed values: flags and the amount band each is crossed with
FLAG_BANDS = {
    "paid_by_cash": "payment_above_200",
    "has_stamp": "payment_above_500",
    "no_dollar_symbol": "payment_above_500",
    "above_handwritten_threshold": "payment_above_500",
    "invalid_invoice_nbr": "payment_above_500",
    "invalid_addr": "payment_above_400",
}

# --- fixed values: audit columns and sentinels of the change tables
OPS, EFF, END = "DL_ETL_OPS_IND", "DL_ETL_EFF_DT", "DL_ETL_END_DT"
RUN, BATCH = "DL_ETL_RUN_DT", "DL_ETL_BATCH_ID"
OPEN_END = "9999-12-31"

# --- fixed values: shortened words and what they expand to once the apostrophe is gone
CONTRACTIONS = {
    "dont": "do not", "cant": "cannot", "wont": "will not", "didnt": "did not",
    "doesnt": "does not", "isnt": "is not", "arent": "are not", "wasnt": "was not",
    "werent": "were not", "havent": "have not", "hasnt": "has not", "hadnt": "had not",
    "couldnt": "could not", "wouldnt": "would not", "shouldnt": "should not", "im": "i am",
    "ive": "i have", "youre": "you are", "youve": "you have", "theyre": "they are",
    "thats": "that is", "whats": "what is", "lets": "let us",
}

# --- fixed values: accented letters and their plain forms, letter by letter
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyy"

# --- fixed values: common English stop words
STOPWORDS = [
    "i", "me", "my", "we", "our", "you", "your", "he", "him", "his", "she", "her", "it", "its",
    "they", "them", "their", "what", "which", "who", "this", "that", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did", "a",
    "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "can", "will", "just", "should", "now",
]
