"""File scans, header probes, image decoding and sinks."""
