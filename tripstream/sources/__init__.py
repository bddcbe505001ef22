"""Readers, writers and derived inputs."""

from .cars import parse_car_lines, read_car_events
from .catalog import TaxiCatalog, register_catalog
from .graph import read_edges, write_tsv
from .mail import ingest_mbox, parse_mbox_mails, read_mails, write_mails
from .rides import (fare_table, line_to_ride, location_queries_from_lines,
                    minutes_queries_from_lines, raw_fares_to_fares, read_fares, read_rides,
                    register_table, ride_table, ride_to_line, rides_from_kafka, rides_to_kafka,
                    trips_to_ride_events)
from .sinks import foreach_batch_sink, places_to_documents, to_points
