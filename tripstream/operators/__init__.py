
from .alerts import long_rides, long_rides_clean, long_rides_pattern
from .cars import (driving_segments, driving_segments_between_stops, driving_sessions,
                   erraticness_desc, segment_stats, sort_car_events)
from .geoqueries import live_queries, match_rides, nearest_taxi, nearest_taxi_ttl, query_distances, running_minima
from .graph import normalized_edges, weighted_pagerank
from .mail import (distinct_mails, exclude_senders, mail_count, member_of_month, reply_graph,
                   reply_pairs, tf_idf)
from .predict import predict_travel_time
from .rides import (arrivals_last_10min, arrivals_window, clean_rides, drop_every_nth_ride, end_events, enrich_rides,
                    event_cell, fares_in_city, fares_in_city_of, fold_changes, high_tip_hours, hourly_tip_leader, hourly_tips,
                    latest_per_taxi, ongoing_rides, ongoing_rides_for_queries, popular_places,
                    popular_places_sql,
                    ride_count, ride_durations, route_heatmap, start_events, unmatched_fares,
                    unmatched_rides)
from .rules import match_rules
from .trades import asof_join, latest_join
