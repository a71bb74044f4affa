"""Printed texts. All of these are fixed values; %s and %d take the values in order."""

# Check name: text when passed, text otherwise.
CHECK_MESSAGES = {
    "completeness": ("Data completeness: %s (>= %s)", "Data completeness: %s (< %s)"),
    "price_range": ("All prices within valid range", "Found %d prices outside valid range"),
    "missing_values": ("No missing values detected", "Missing values: %d in prices, %d in returns"),
    "outliers": ("No extreme return outliers detected", "Found %d extreme returns (>%s%%)"),
    "duplicates": ("No duplicate records found", "Found %d duplicate records"),
}
OUTLIER = "%s: %s"
NO_PRICE_DATA = "No price data retrieved"
NO_NEWS = "No news"

# Defaults for what is absent.
ABSENT = "N/A"
NOTHING = "None"

# Search phrases.
CRYPTO_SUFFIX = "-USD"
CRYPTO_PHRASE = " crypto"
STOCK_PHRASE = " stock"

# Recap.
RECAP_TITLE = "Daily Market Recap - %s"
DATE_RANGE = "%s to %s"
HEADLINE = "%d. [%s] %s"
BYLINE = "%s - %s"
READ_MORE = ' <link href="%s">Read more</link>'
SUMMARY_HEADING = "Market Overview:"
SUMMARY_LINES = (
    "• Total Assets Tracked: %d",
    "• Average Return: %s",
    "• Gainers: %d | Losers: %d",
    "• Data Quality Score: %s",
)
QUALITY_SCORE = "Quality Score: %s"
PASSED_HEADING = "Checks Passed (%d):"
FAILED_HEADING = "Checks Failed (%d):"
PASSED_MARK = "✓ "
FAILED_MARK = "✗ "
PASSED_BULLET = "✅ "
FAILED_BULLET = "❌ "
GAIN_COLOUR = "green"
LOSS_COLOUR = "red"

# Why a payload gives no bars.
REJECTIONS = {
    "unanswered": "the request was not answered",
    "unreadable": "the body is no single JSON document",
    "no_result": "the document holds no result",
    "no_bars": "the result holds no bars",
    "short": "a series ends before the last bar",
    "no_close": "no bar has a close",
    "no_number": "a kept bar holds something that is no number",
    "not_storable": "a time or volume is beyond what can be stored",
}
