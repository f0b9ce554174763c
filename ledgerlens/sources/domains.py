"""Fixed values of the feed's domains.

List order matters; repeated entries give the weights of a weighted choice.
"""

FIRST_NAMES = ["Aarav", "Vivaan", "Aditya", "Isha", "Anaya", "Diya", "Rohan", "Neha", "Kabir", "Mira"]
LAST_NAMES = ["Sharma", "Patel", "Gupta", "Singh", "Reddy", "Iyer", "Khan", "Mehta", "Joshi", "Nair"]
CITIES = ["Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Pune", "Kolkata", "Ahmedabad"]
STATES = ["MH", "DL", "KA", "TG", "TN", "WB", "GJ"]
CHANNELS = ["ATM", "UPI", "POS", "NETBANKING", "MOBILE", "BRANCH"]
TXN_TYPES = ["DEBIT", "CREDIT"]
CATEGORIES = ["GROCERY", "TRAVEL", "FUEL", "DINING", "SHOPPING", "UTILITIES", "CASH", "SALARY"]
ACCOUNT_TYPES = ["SAVINGS", "CURRENT", "SALARY", "NRI"]
KYC_STATUS = ["VERIFIED", "PENDING", "REJECTED"]
FEED_KYC_STATUS = ["REJECTED", "PENDING", "VERIFIED"]   # by key of the test feed
REGIONS = ["WEST", "NORTH", "SOUTH", "EAST"]
SEGMENTS = ["RETAIL", "PREMIUM", "WEALTH", "SME"]
RISK_LEVELS = ["LOW", "LOW", "MEDIUM", "HIGH"]
ACCOUNT_STATUS = ["ACTIVE", "ACTIVE", "ACTIVE", "DORMANT", "CLOSED"]
CARD_TYPES = ["DEBIT", "CREDIT", "PREPAID"]
CARD_STATUS = ["ACTIVE", "ACTIVE", "BLOCKED"]
TXN_STATUS = ["SUCCESS", "SUCCESS", "SUCCESS", "FAILED", "REVERSED"]
LOAN_TYPES = ["HOME", "AUTO", "PERSONAL", "BUSINESS"]
LOAN_STATUS = ["SUBMITTED", "APPROVED", "REJECTED", "UNDER_REVIEW"]
CARD_SHARE = 7            # of 10 accounts hold a card
FRAUD_ONE_IN = 5
