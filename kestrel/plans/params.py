"""Parameters the registered queries run with on the driver tables."""

# Home country for the traffic questions (NATION_0 has no supplier at the
# smallest scale, so it would give an empty answer there).
HOME = "NATION_19"
# Key zones for the pivot, in output column order.
KEY_ZONES = ("NATION_3", "NATION_1", "NATION_24", "NATION_7", "NATION_12", "NATION_0")
# Log supervision: gap slot width and the component whose open requests count.
SLOT_MINUTES = 15
INCOMPLETE_COMPONENT = "B"
# Record matching: part names compared within (brand, type) blocks.
MATCH_BLOCK = ("p_brand", "p_type")
MATCH_THRESHOLD = 0.7
MATCH_BLOCK_COARSE = ("p_brand",)
# Streams: events arrive in so many pieces; every twentieth one comes again two pieces later. The horizon
# must cover the time between the two.
FEED_PIECES = 5
REPEATED_EVENT = 20
REPEAT_HORIZON_DAYS = 30
# Moving averages of a vehicle's speed.
FRAME_SECONDS = 6 * 3600
