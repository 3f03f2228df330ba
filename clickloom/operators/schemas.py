"""Column lists of the warehouse tables (all text)."""

# The 15 columns of the typed event table, in table order.
EVENT_COLUMNS = [
    "_track_id", "time", "type", "distinct_id", "lib", "event", "properties", "_flush_time",
    "map_id", "user_id", "recv_time", "extractor", "project_id", "project", "ver",
]
# The same columns in the order of the daily log table.
LOG_COLUMNS = [
    "distinct_id", "_flush_time", "_track_id", "event", "project", "user_id", "map_id", "lib",
    "properties", "project_id", "ver", "extractor", "time", "type", "recv_time",
]

# The 82 columns of the flattened event table, in table order.
FLAT_COLUMNS = [
    "ver", "recv_time", "lib_lib", "lib_lib_method", "lib_lib_version", "lib_app_version",
    "lib_lib_detail", "extractor_s", "extractor_c", "extractor_e", "extractor_f", "extractor_n",
    "extractor_o", "project", "tmp_hybrid_h5", "type", "tmp_track_id", "map_id", "user_id",
    "project_id", "distinct_id", "tmp_flush_time", "time", "event", "properties_os",
    "properties_is_first_time", "properties_network_type", "properties_wifi", "properties_ip",
    "properties_screen_height", "properties_referrer", "properties_deviceId", "properties_userID",
    "properties_PushStatus", "properties_url_path", "properties_device_id",
    "properties_planner_number", "properties_latest_search_keyword", "properties_province",
    "properties_url", "properties_latest_referrer", "properties_carrier", "properties_os_version",
    "properties_referrer_host", "properties_is_first_day", "properties_city", "properties_model",
    "properties_screen_width", "properties_utm_source", "properties_app_version", "properties_lib",
    "properties_stock_number", "properties_country", "properties_utm_campaign", "properties_title",
    "properties_lib_version", "properties_latest_traffic_source_type", "properties_PlatformType",
    "properties_latest_referrer_host", "properties_platForm", "properties_manufacturer",
    "properties_is_login_id", "properties_v1_element_content", "properties_v1_message_title",
    "properties_v1_message_type", "properties_v1_symbol", "properties_v1_stock_name",
    "properties_v1_lcs_name", "properties_v1_lcs_id", "properties_v1_isfirst",
    "properties_v1_share_channel", "properties_v1_source", "properties_v1_order",
    "properties_v1_custom_params", "properties_v1_custom_params2", "properties_v1_environment",
    "properties_v1_page_url", "properties_v1_remain", "properties_v1_paly_time",
    "properties_v1_ispush", "properties_v1_ishot", "properties_v1_message_id",
]

# Envelope keys that are not part of the properties of a flat history line.
HISTORY_ENVELOPE = [
    "_track_id", "time", "type", "distinct_id", "lib", "event", "_flush_time", "map_id", "userid",
    "recv_time", "extractor", "project_id", "project", "ver",
]
HISTORY_EPOCH = "1970-01-01 08:00:00.000"

# Property fields of a behaviour record.
BEHAVIOUR_PROPERTIES = [
    "v1_element_content", "v1_message_title", "v1_message_id", "v1_custom_params", "wx_openid",
    "wx_uid", "v1_lcs_name", "v1_source", "v1_lcs_id", "v1_invest_id", "v1_element_title",
    "v1_element_type", "v1_is_push", "v1_push_type", "v1_is_live", "v1_push_title", "v1_page_url",
    "v1_page_title", "v1_tg_name", "v1_tg_id", "v1_wx_username", "v1_tg_open_id", "sc_comments",
    "sport_name", "v1_custom_params2", "infor_list", "dt_commit_time",
]

# Output fields of the behaviour routes (after "type").
_COMMON = [
    "v1_element_content", "v1_message_title", "v1_message_id", "v1_custom_params", "wx_openid",
    "wx_uid", "v1_lcs_name", "v1_source", "v1_lcs_id", "v1_invest_id",
]
ARTICLE_FIELDS = [*_COMMON, "v1_is_live", "v1_page_url"]
PUSH_FIELDS = [
    *_COMMON, "v1_element_title", "v1_element_type", "v1_is_push", "v1_push_type",
    "v1_push_title", "v1_page_url",
]
ACTIVITY_FIELDS = [*_COMMON, "v1_element_title", "v1_element_type", "v1_page_url"]
PLAN_FIELDS = [
    "v1_element_content", "v1_page_title", "v1_tg_name", "v1_tg_id", "wx_openid", "wx_uid",
    "v1_lcs_name", "v1_lcs_id", "v1_wx_username", "v1_page_url", "v1_message_title",
    "v1_tg_open_id",
]
ASSESS_FIELDS = [
    "v1_element_content", "v1_page_title", "wx_openid", "wx_uid", "v1_custom_params",
    "v1_page_url",
]
CAMPAIGN_FIELDS = [
    "sc_comments", "sport_name", "infor_list", "dt_commit_time", "wx_openid", "wx_uid",
    "v1_custom_params", "v1_custom_params2", "v1_page_url", "v1_page_title", "v1_tg_id",
    "v1_tg_name",
]

# The 29 columns of the live statistics table (name, type) in table order.
LIVE_STATS = [
    ("live_id", "bigint"), ("circle_id", "bigint"), ("lcs_id", "bigint"), ("lcs_name", "string"),
    ("start_time", "string"), ("end_time", "string"), ("live_title", "string"),
    ("live_status", "int"), ("view_count", "int"), ("view_count_robot", "int"),
    ("first_view_count", "int"), ("max_living_count", "int"), ("new_follow_count", "int"),
    ("comment_count", "int"), ("comment_peoples", "int"), ("gift_count", "int"),
    ("share_count", "int"), ("new_follow_count_robot", "int"), ("comment_count_robot", "int"),
    ("comment_peoples_robot", "int"), ("gift_count_robot", "int"), ("share_count_robot", "int"),
    ("old_user_staying_average", "minutes"), ("old_user_staying_max", "int"),
    ("old_user_staying_min", "int"), ("new_user_staying_average", "minutes"),
    ("new_user_staying_max", "int"), ("new_user_staying_min", "int"), ("live_type", "int"),
]
# The columns of the live information table that is kept up to date by key.
LIVE_INFO = [
    ("circle_id", "circle_id", "int"), ("notice_id", "live_id", "int"),
    ("p_uid", "lcs_id", "bigint"), ("live_title", "live_title", "string"),
    ("view_count", "view_count", "int"), ("first_view_count", "first_view_count", "int"),
    ("max_living_count", "max_living_count", "bigint"),
    ("new_follow_count", "new_follow_count", "int"), ("comment_count", "comment_count", "int"),
    ("comment_peoples", "comment_peoples", "bigint"), ("gift_count", "gift_count", "int"),
    ("share_count", "share_count", "int"),
    ("old_user_staying_average", "old_user_staying_average", "double"),
    ("old_user_staying_max", "old_user_staying_max", "double"),
    ("old_user_staying_min", "old_user_staying_min", "double"),
    ("new_user_staying_average", "new_user_staying_average", "double"),
    ("new_user_staying_max", "new_user_staying_max", "double"),
    ("new_user_staying_min", "new_user_staying_min", "double"),
]
