"""Schemas of the logical tables."""

RSS_STORY = "source string, domain string, title string, url string, pub_date string, publish_date string, summary string"
RAW_RECORD = (
    "id string, indexed_date string, language string, media_name string, media_url string, publish_date string, title string, url string, description string, "
    "collected_with string, collected_at string, final_url string, http_status int, success boolean, error string, scraped_at string"
)
URL_LISTING = "id string, indexed_date string, language string, media_name string, media_url string, publish_date string, title string, url string, my_topic string"
SCRAPED_ARTICLE = "url string, final_url string, http_status int, description string, title string, success boolean, error string, scraped_at string, my_topic string"
#: Column order of published articles.
CLEAN_ARTICLE = ("media_url", "title", "description", "publish_date", "url", "my_topic")
REVISION = "version string, committed_at timestamp, additions int, deletions int, file string, content string"
EXPECTED_COUNT = "day date, outlet string, expected long"
RSS_CHANNEL = "channel struct<item: array<struct<title: string, link: string, pubDate: string, description: string>>>"
