"""Stream entry points.  The reference has no streaming operators; this
package only runs the batch ``prediction_export`` on a stream source."""
