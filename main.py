"""Script for spark-submit: `spark-submit --py-files incident_stream.zip main.py process ...`."""

from incident_stream.cli import main

if __name__ == "__main__":
    main()
