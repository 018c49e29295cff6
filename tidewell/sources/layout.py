"""Names and patterns of the recording folders that the catalogue describes."""

# They must equal those of existing folders and catalogues for results to agree.
RAW_FILE = r"(?i)(\.ome\.tiff?|\.tiff?)$|_metadata\.txt$|^AcqSettings\.txt$"
PROVENANCE_FILE = r"(?i)\.(json|txt|mat|log|cxc|csv|md)$"
DERIVED_TOPS = ("processed_ngff", "processed_tiff_series_split", "decon_stage", "zarr_mirror")
PROVENANCE_TOPS = ("mip_movies", "decon_qc")
WRAPPERS = ("processed_tiff_series_split", "decon_stage", "zarr_mirror", "Decon")
VIEWER_TOP, VIEWER_STORE = "viewer", "_dsr.ome.zarr"
PROJECTIONS, FIRST_FRAME = "MIPs", "_T000.tif"
MIN_SUGGEST_BYTES = 50 * 2**20
BEAD_OR_PSF = r"(?i)bead|psf|focalcheck"
BAD_SIGNALS = ("dud", "dead", "corrupt")
BUSY_STATUSES = ("running", "in_progress", "reprocessing", "pending")
ACTIVE_DAYS, GIVE_UP_AFTER = 14, 3
SIGNAL_PRIORITY = {"ok": 0, "unknown": 1, "dud": 2}
FLUOROPHORES = {
    r"mng|ng|gfp|calcein": "GFP/mNG (488)",
    r"msca|msc|scarlet|568|tdtomato|tdtom|(?:^|[_-])sca?(?:[_-]|$)": "mScarlet/CF568/TdTomato (561)",
    r"cf647|647|sir": "CF647/SiR (640)",
    r"hoechst|dapi|violet": "Hoechst/Violet (405)",
    r"beads|yg": "YG Beads (488 nm excitation)",
    r"cav": "Calcein Violet (cav) [Excited by 405nm]",
    r"flm": "Fetal Liver Macrophage (flm)",
    r"2xfyve|fyve": "FYVE domain (PI3P probe, fused to GFP/mScarlet -- not a separate channel)",
}

#: Substrings of a path in order of preference; a parameter of the site.
ROOT_RANKS = ("/main/", "/archive/", "/scratch/")
